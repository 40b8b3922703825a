"""Data profiling used to prepare and sanity-check a back-test (AG6-AG11, JN12).

All are single aggregations (partial aggregation before any shuffle); the
top-k report keeps its limit because the limit is the feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TEST, TRAIN, VALIDATE, PanelConfig
from ..sources.scans import scan_weather


# -- AG6 --------------------------------------------------------------------
def dataset_span(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.min("starttime").alias("first_ts"), F.max("starttime").alias("last_ts"), F.count(F.lit(1)).alias("n_rows")
    )


# -- AG7 --------------------------------------------------------------------
def covariate_coverage(weather_raw: DataFrame, cfg: PanelConfig) -> DataFrame:
    w = scan_weather(weather_raw, cfg)
    return w.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min(cfg.time_column).alias("first_day"),
        F.max(cfg.time_column).alias("last_day"),
        F.count("temp").alias("n_temp"),
        F.count("prcp").alias("n_prcp"),
    )


# -- AG8 --------------------------------------------------------------------
def split_counts(prepped: DataFrame, cfg: PanelConfig) -> DataFrame:
    sp = F.col("splits")
    return prepped.groupBy(F.col(cfg.series_column).alias("series")).agg(
        F.count_if(sp == F.lit(TRAIN)).alias("n_train"),
        F.count_if(sp == F.lit(VALIDATE)).alias("n_validate"),
        F.count_if(sp == F.lit(TEST)).alias("n_test"),
    )


# -- AG9 --------------------------------------------------------------------
def series_ranges(prepped: DataFrame, cfg: PanelConfig) -> DataFrame:
    t = cfg.time_column
    return prepped.groupBy(F.col(cfg.series_column).alias("series")).agg(
        F.min(t).alias("first_day"), F.max(t).alias("last_day"), F.count(F.lit(1)).alias("n_days")
    )


def split_boundaries(prepped: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Global last day, the cut dates (the last day *before* each window: TEST is
    ``date > test_cut``) and the first day of each window."""
    mx = F.max(cfg.time_column)
    val = cfg.test_length + cfg.validate_length
    return prepped.agg(
        mx.alias("last_day"),
        F.date_sub(mx, cfg.test_length).alias("test_cut"),
        F.date_sub(mx, val).alias("validate_cut"),
        F.date_sub(mx, cfg.test_length - 1).alias("test_start"),
        F.date_sub(mx, val - 1).alias("validate_start"),
    )


# -- AG10 -------------------------------------------------------------------
def topk_mean_test(prepped: DataFrame, cfg: PanelConfig, k: int = 5) -> DataFrame:
    g = prepped.where(F.col("splits") == F.lit(TEST)).groupBy(F.col(cfg.series_column).alias("series")).agg(
        F.avg(F.col(cfg.target_column).cast("double")).alias("mean_test")
    )
    return g.orderBy(F.desc("mean_test"), F.asc("series")).limit(k)


# -- JN12 -------------------------------------------------------------------
def metadata_coverage(prepped: DataFrame, meta: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Which series have a known capacity, joined on the series *name*.

    A dimension row without a capacity does not count; of several rows of one
    name any with a capacity does.
    """
    names = prepped.select(F.col(cfg.series_column).alias("series")).distinct()
    known = meta.groupBy(F.col("name").alias("series")).agg((F.count("capacity") > 0).alias("_known"))
    return names.join(known, "series", "left").select("series", F.coalesce("_known", F.lit(False)).alias("has_metadata"))
