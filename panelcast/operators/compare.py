"""Ranking and comparability (WN4, CM1-CM3).

Ranking works on the metrics frame (variants x models rows), partitioned by
variant so two variants of one model never collide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import finite_or_inf

RANKING_METRICS = ("mae", "rmse", "smape", "quantile_loss")


# -- WN4 + CM1 ---------------------------------------------------------------
def rank_models(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rank by RMSE then MAE (non-finite or missing sink to +inf), then model.

    Missing metric columns count as +inf, missing ``n_points`` as NaN; the
    result has one uniform shape plus ``rank`` and ``winner``.
    """
    cols = set(metrics.columns)
    m = metrics
    for c in RANKING_METRICS:
        if c not in cols:
            m = m.withColumn(c, F.lit(float("inf")))
    if "n_points" not in cols:
        m = m.withColumn("n_points", F.lit(float("nan")))
    w = Window.partitionBy(*by).orderBy(finite_or_inf("rmse"), finite_or_inf("mae"), F.asc("model")) if by else \
        Window.orderBy(finite_or_inf("rmse"), finite_or_inf("mae"), F.asc("model"))
    ranked = m.withColumn("rank", F.row_number().over(w).cast("int"))
    return ranked.select(
        *by,
        "model",
        *[F.col(c).cast("double").alias(c) for c in RANKING_METRICS],
        F.col("n_points").cast("double").alias("n_points"),
        "rank",
        (F.col("rank") == 1).alias("winner"),
    )


# -- CM2 --------------------------------------------------------------------
def parity_warnings(ranking: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per group whose models have unequal (positive, finite) numbers of
    scored points; the message names each model and its number by rank."""
    n = F.col("n_points")
    valid = ranking.where(n.isNotNull() & ~F.isnan(n) & (F.abs(n) != F.lit(float("inf"))) & (n > 0))
    g = valid.groupBy(*by).agg(
        F.count_distinct("n_points").alias("distinct_counts"),
        F.array_sort(F.collect_list(F.struct("rank", "model", n.cast("long").alias("n")))).alias("_rows"),
    )
    detail = F.array_join(F.transform("_rows", lambda r: F.concat(r["model"], F.lit("="), r["n"].cast("string"))), ", ")
    msg = F.concat(F.lit("unequal coverage, compare ranks with care: "), detail, F.lit(" scored points"))
    return g.where(F.col("distinct_counts") > 1).select(*by, "distinct_counts", msg.alias("warning"))
