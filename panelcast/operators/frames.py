"""Mapping model outputs onto the one long prediction frame.

PR14/PR15 ``from_point_stderr``  (series, forecast_timestamp, forecast_value,
          standard_error) -> Gaussian quantiles, date cast, model tag, order.
WN2      ``horizon_rank``         horizon_step = first-rank of date per series.
PR16     ``flatten_nested``       nested ``predicted_<target>`` struct, quantiles
          matched by level (not position); already-flat input passes through.
SE1      ``union_predictions``    concatenate per-model frames by name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import QUANTILE_COLUMNS, QUANTILES
from ..functions.scalar import gaussian_quantile, quantile_by_level
from ..schemas import PREDICTIONS, conform


# -- WN2 --------------------------------------------------------------------
def horizon_rank(frame: DataFrame, keys: tuple[str, ...] = ("series", "model")) -> DataFrame:
    """1-based step = row_number of date within (series, model[, variant])."""
    w = Window.partitionBy(*keys).orderBy("date")
    return frame.withColumn("horizon_step", F.row_number().over(w).cast("int"))


# -- PR14 + PR15 ----------------------------------------------------------------
def from_point_stderr(raw: DataFrame, series_col: str, model: str) -> DataFrame:
    """Point + Gaussian standard error -> standard frame (deciles by fixed z)."""
    base = raw.select(
        F.col(series_col).cast("string").alias("series"),
        F.to_date("forecast_timestamp").alias("date"),
        F.col("forecast_value").cast("double").alias("forecast"),
        *[gaussian_quantile("forecast_value", "standard_error", q).alias(c) for q, c in zip(QUANTILES, QUANTILE_COLUMNS)],
        F.lit(model).alias("model"),
    )
    return conform(horizon_rank(base), PREDICTIONS)


# -- PR16 -------------------------------------------------------------------
def flatten_nested(raw: DataFrame, target: str, series_col: str, time_col: str, model: str) -> DataFrame:
    """Nested ``predicted_<target>{value, quantile_values[], quantile_predictions[]}``
    -> standard frame. A missing level raises inside the task; a frame that
    already has the flat columns passes through."""
    nested = f"predicted_{target}"
    if nested not in raw.columns:
        flat = raw.select(
            F.col(series_col).cast("string").alias("series"),
            F.to_date(F.col(time_col)).alias("date"),
            F.col("forecast").cast("double").alias("forecast"),
            *[F.col(c).cast("double").alias(c) for c in QUANTILE_COLUMNS],
            F.lit(model).alias("model"),
        )
        return conform(horizon_rank(flat), PREDICTIONS)
    s = F.col(nested)
    base = raw.select(
        F.col(series_col).cast("string").alias("series"),
        F.to_date(F.col(time_col)).alias("date"),
        s["value"].cast("double").alias("forecast"),
        *[
            quantile_by_level(s["quantile_values"], s["quantile_predictions"], q).alias(c)
            for q, c in zip(QUANTILES, QUANTILE_COLUMNS)
        ],
        F.lit(model).alias("model"),
    )
    return conform(horizon_rank(base), PREDICTIONS)


# -- SE1 --------------------------------------------------------------------
def union_predictions(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [conform(f, PREDICTIONS) for f in frames])
