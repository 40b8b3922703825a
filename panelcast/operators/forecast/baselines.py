"""Train-mean baseline with a Gaussian spread: point = series train mean,
standard error = series train standard deviation (population), for the days
after each series' last train day. It feeds the point + standard-error
mapping (PR14/PR15) and the step rank (WN2) with data-derived input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...config import TEST, PanelConfig
from ..frames import from_point_stderr


def mean_stderr_raw(prepped: DataFrame, cfg: PanelConfig, horizon: int | None = None) -> DataFrame:
    s, t, y = cfg.series_column, cfg.time_column, cfg.target_column
    h = horizon or cfg.horizon
    stats = prepped.where(F.col("splits") != F.lit(TEST)).groupBy(F.col(s).alias("series")).agg(
        F.avg(F.col(y).cast("double")).alias("forecast_value"),
        F.stddev_pop(F.col(y).cast("double")).alias("standard_error"),
        F.max(t).alias("last_date"),
    )
    return stats.select(
        "series",
        F.explode(F.sequence(F.lit(1), F.lit(h))).alias("h"),
        "forecast_value",
        "standard_error",
        "last_date",
    ).select(
        "series",
        F.date_add("last_date", F.col("h")).cast("timestamp_ntz").alias("forecast_timestamp"),
        "forecast_value",
        "standard_error",
    )


def mean_forecast(prepped: DataFrame, cfg: PanelConfig, model: str = "train_mean") -> DataFrame:
    return from_point_stderr(mean_stderr_raw(prepped, cfg), "series", model)
