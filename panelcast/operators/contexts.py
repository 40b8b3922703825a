"""Per-series model inputs and the long <-> array forecast shapes.

WN3  ``series_contexts``   last-N non-TEST values per series as an array.
PR18 ``expand_horizon``    response arrays -> one row per step (date = last + step).
PR19 ``to_response``       long forecast -> response arrays per series.
PR20 ``truncate_context``  keep the last N values of a request array.
JN11 ``responses_to_frame`` responses joined to last dates *by series*.

Memory bound: a context is at most ``context_len`` values; the per-series
row limit runs as a WindowGroupLimit *before* the collect, so no task ever
holds more than ``context_len`` values of one series, however long it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import QUANTILE_COLUMNS, TEST, PanelConfig
from ..functions.scalar import last_n
from ..sources.scans import scan_panel


# -- WN3 --------------------------------------------------------------------
def series_contexts(
    prepped: DataFrame, cfg: PanelConfig, context_len: int | None = None, keys: tuple[str, ...] = ()
) -> DataFrame:
    """(*keys, series, context array<double> oldest->newest, last_date, n) from
    non-TEST rows; ``keys`` (e.g. a sweep variant) partition the contexts too."""
    n = context_len or cfg.context_len
    s, t, y = cfg.series_column, cfg.time_column, cfg.target_column
    hist = scan_panel(prepped, cfg, keys).where(F.col("splits") != F.lit(TEST)).select(
        *keys, F.col(s).alias("series"), F.col(t).alias("date"), F.col(y).cast("double").alias("y")
    )
    # the last n rows are those that n rows further there is none; by ascending days, as the stored panel lies
    w = Window.partitionBy(*keys, "series").orderBy("date")
    recent = hist.withColumn("_later", F.lead(F.lit(True), n).over(w)).where(F.col("_later").isNull())
    grouped = recent.groupBy(*keys, "series").agg(
        F.array_sort(F.collect_list(F.struct("date", "y"))).alias("_pts"), F.max("date").alias("last_date")
    )
    ctx = F.transform("_pts", lambda p: p["y"])
    return grouped.select(*keys, "series", ctx.alias("context"), "last_date", F.size(ctx).alias("n"))


def contexts_long(contexts: DataFrame) -> DataFrame:
    """One row per context value: (series, pos 1-based, value, last_date)."""
    return contexts.select(
        "series", "last_date", F.posexplode("context").alias("_p", "value")
    ).select("series", (F.col("_p") + 1).alias("pos"), "value", "last_date")


# -- PR20 -------------------------------------------------------------------
def truncate_context(requests: DataFrame, n: int) -> DataFrame:
    return requests.withColumn("context", last_n("context", n))


# -- PR18 -------------------------------------------------------------------
def expand_horizon(responses: DataFrame, model: str | None = None) -> DataFrame:
    """Arrays (forecast, q10..q90) + last_date -> standard long rows.

    ``model`` tags the rows; when None, a ``model`` column must be present.
    """
    arrays = ["forecast", *QUANTILE_COLUMNS]
    zipped = F.arrays_zip(*[F.col(a).alias(a) for a in arrays])
    model_col = F.lit(model) if model is not None else F.col("model")
    exploded = responses.select(
        F.col("series_id").alias("series"),
        "last_date",
        model_col.alias("model"),
        F.posexplode(zipped).alias("_p", "_v"),
    )
    return exploded.select(
        "series",
        F.date_add("last_date", F.col("_p") + 1).alias("date"),
        (F.col("_p") + 1).cast("int").alias("horizon_step"),
        *[F.col(f"_v.{a}").cast("double").alias(a) for a in arrays],
        F.col("model").cast("string").alias("model"),
    )


# -- JN11 -------------------------------------------------------------------
def responses_to_frame(responses: DataFrame, contexts: DataFrame, model: str) -> DataFrame:
    """Attach each response to its series' last date by key, never by position."""
    last = contexts.select(F.col("series").alias("series_id"), "last_date")
    return expand_horizon(responses.join(last, "series_id", "inner"), model)


# -- PR19 -------------------------------------------------------------------
def _field(name: str):
    return lambda x: x[name]


def to_response(long: DataFrame) -> DataFrame:
    """Long forecast rows -> one response row per (model, series) with arrays
    ordered by step. Bounded by the horizon per group."""
    arrays = ["forecast", *QUANTILE_COLUMNS]
    g = long.groupBy("model", "series").agg(
        F.array_sort(F.collect_list(F.struct("horizon_step", *arrays))).alias("_steps"),
        F.max("horizon_step").alias("horizon"),
    )
    return g.select(
        "model",
        F.col("series").alias("series_id"),
        F.col("horizon").cast("int").alias("horizon"),
        *[F.transform("_steps", _field(a)).alias(a) for a in arrays],
    )
