"""panelcast: Spark-native panel demand forecasting and back-testing.

Event facts -> gap-filled daily per-series panel with covariates -> date
splits -> interchangeable forecasters -> one long quantile-forecast table ->
one shared scorer -> ranking. Every step is a DataFrame plan.
"""

__version__ = "0.1.0"
