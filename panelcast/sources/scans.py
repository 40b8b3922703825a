"""Scans (SC1-SC3, SC5, SC6). Each asserts the declared columns and types of its source: a
wrong type is an error at the boundary, never a silent cast. Column pruning and filter pushdown are left
to Catalyst: each scan only declares the columns and predicates it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TEST, PanelConfig
from ..functions.scalar import date_from_parts, sentinel_to_null
from ..schemas import META, TRIPS, WEATHER_RAW, assert_columns, declared


def _frame(spark: SparkSession | None, src: DataFrame | str) -> DataFrame:
    if isinstance(src, DataFrame):
        return src
    if spark is None:
        raise ValueError("a path source needs a SparkSession")
    return spark.read.parquet(src)


# -- SC1 --------------------------------------------------------------------
def scan_trips(src: DataFrame | str, spark: SparkSession | None = None) -> DataFrame:
    """Event facts in the canonical column set."""
    return declared(_frame(spark, src), TRIPS, "trips")


# -- SC2 --------------------------------------------------------------------
def scan_weather(src: DataFrame | str, cfg: PanelConfig, spark: SparkSession | None = None) -> DataFrame:
    """One covariate row per day for one station over the year-shard window.

    ``year`` is compared as a string, like a shard suffix; on a dataset
    written with ``partitionBy("year")`` it becomes a PartitionFilter, and the
    station equalities are pushed to the Parquet reader. Sentinels become NULL.
    The dimension's grain (one row per day) is enforced: duplicate days are
    averaged, so the result is bounded by the number of days in the window
    and is safe to broadcast.
    """
    y0, y1 = cfg.weather_years()
    w = cfg.weather
    frame = _frame(spark, src)
    # a partition column's type is inferred from its folder names: any type that compares as text will do for the year
    assert_columns(frame, T.StructType([f for f in WEATHER_RAW.fields if f.name != "year"]), "weather")
    raw = frame.select(*WEATHER_RAW.fieldNames()).where(
        F.col("year").between(F.lit(y0), F.lit(y1)) & (F.col("stn") == F.lit(w.stn)) & (F.col("wban") == F.lit(w.wban))
    )
    day = raw.select(
        date_from_parts("year", "mo", "da").alias(cfg.time_column),
        sentinel_to_null("temp", w.temp_missing).alias("temp"),
        sentinel_to_null("prcp", w.prcp_missing).alias("prcp"),
    )
    return day.groupBy(cfg.time_column).agg(F.avg("temp").alias("temp"), F.avg("prcp").alias("prcp"))


# -- SC3 --------------------------------------------------------------------
def scan_meta(src: DataFrame | str, spark: SparkSession | None = None) -> DataFrame:
    """Dimension rows in the declared column set."""
    return declared(_frame(spark, src), META, "metadata")


# -- SC5 --------------------------------------------------------------------
def scan_panel(prepped: DataFrame, cfg: PanelConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """The four columns a univariate model reads: series, time, target, splits
    (and ``keys``, where the panel holds several variants)."""
    return prepped.select(*keys, cfg.series_column, cfg.time_column, cfg.target_column, "splits")


# -- SC6 --------------------------------------------------------------------
def actuals(prepped: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Held-out TEST actuals, in the standard (series, date, actual) names."""
    return prepped.where(F.col("splits") == F.lit(TEST)).select(
        F.col(cfg.series_column).alias("series"),
        F.col(cfg.time_column).cast("date").alias("date"),
        F.col(cfg.target_column).cast("double").alias("actual"),
    )
