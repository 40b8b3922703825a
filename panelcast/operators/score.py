"""One scorer for every model and variant (JN7, JN8, AG12-AG17).

All models are scored in one pass: the prediction frame carries ``model``
(and optionally ``variant``), and the metrics are grouped by those keys, so
adding a model adds rows, not jobs. The (series, date) join runs on frames
bounded by series x horizon x models.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import QUANTILES
from ..functions.metrics import abs_error, mean_pinball_term, smape_term, sq_error

KEYS = ("series", "date")


def _norm_dates(df: DataFrame) -> DataFrame:
    # PR21: both join sides as plain dates.
    return df.withColumn("date", F.col("date").cast("date"))


# -- JN7 --------------------------------------------------------------------
def join_actuals(preds: DataFrame, actuals: DataFrame) -> DataFrame:
    """Inner join on (series, date); NULL keys never match (keys are validated
    upstream, PR1)."""
    a = _norm_dates(actuals.select("series", "date", F.col("actual").cast("double").alias("actual")))
    return _norm_dates(preds).join(a, list(KEYS), "inner")


def metric_columns(levels=QUANTILES, hit: Column | None = None) -> list[Column]:
    """The metrics over the rows, or over those where ``hit`` holds."""
    f, a = F.col("forecast"), F.col("actual")
    of = (lambda c: c) if hit is None else (lambda c: F.when(hit, c))
    return [
        F.avg(of(abs_error(f, a))).alias("mae"),
        F.sqrt(F.avg(of(sq_error(f, a)))).alias("rmse"),
        (F.avg(of(smape_term(f, a))) * F.lit(100.0)).alias("smape"),
        F.avg(of(mean_pinball_term(a, levels))).alias("quantile_loss"),
        F.count(of(F.lit(1))).alias("n_points"),
    ]


# -- AG15 -------------------------------------------------------------------
def evaluate(preds: DataFrame, actuals: DataFrame, by: tuple[str, ...] = ("model",), levels=QUANTILES) -> DataFrame:
    """mae, rmse, smape (percent), quantile_loss, n_points per ``by`` group."""
    return join_actuals(preds, actuals).groupBy(*by).agg(*metric_columns(levels))


# -- AG16 -------------------------------------------------------------------
def evaluate_per_series(
    preds: DataFrame, actuals: DataFrame, by: tuple[str, ...] = ("model",), levels=QUANTILES
) -> DataFrame:
    return join_actuals(preds, actuals).groupBy(*by, "series").agg(*metric_columns(levels))


def evaluate_both(
    preds: DataFrame, actuals: DataFrame, by: tuple[str, ...] = ("model",), levels=QUANTILES
) -> DataFrame:
    """Overall and per-series metrics in one aggregation (grouping sets);
    overall rows have ``series`` NULL and ``level`` = 'overall'."""
    j = join_actuals(preds, actuals)
    g = j.groupingSets([[*by], [*by, "series"]], *by, "series").agg(
        *metric_columns(levels), F.grouping_id().alias("_gid")
    )
    return g.withColumn("level", F.when(F.col("series").isNull() & (F.col("_gid") > 0), F.lit("overall")).otherwise(F.lit("series"))).drop("_gid")


# -- JN8 --------------------------------------------------------------------
def overlap_counts(preds: DataFrame, actuals: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """Per group: prediction rows, matched rows, predictions without an actual,
    and distinct actual keys without a prediction. Repeated actuals count once,
    repeated predictions as often as they occur. Where the actuals carry ``by``
    columns too (a variant), each group is held against its own actuals."""
    own = [c for c in by if c in actuals.columns]
    a = _norm_dates(actuals.select(*own, *KEYS)).distinct().withColumn("_hit", F.lit(True))
    j = _norm_dates(preds.select(*by, *KEYS)).join(a, [*own, *KEYS], "left")
    per = a.groupBy(*own).agg(F.count_distinct(*KEYS).alias("_n_actuals"))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    g = j.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.count_if(hit).alias("n_matched"),
        F.count_if(~hit).alias("predictions_unmatched"),
        F.count_distinct(F.when(hit, F.struct(*KEYS))).alias("_keys_hit"),
    )
    total = a.select(F.count_distinct(*KEYS)).scalar()
    g = g.join(per, own, "left") if own else g.withColumn("_n_actuals", total)
    return g.select(
        *by,
        "n_predictions",
        "n_matched",
        "predictions_unmatched",
        (F.coalesce("_n_actuals", F.lit(0)) - F.col("_keys_hit")).alias("actuals_unmatched"),
    )


# -- AG17 -------------------------------------------------------------------
def evaluate_checked(preds: DataFrame, actuals: DataFrame, by: tuple[str, ...] = ("model",), levels=QUANTILES) -> DataFrame:
    """``evaluate`` in which a group that meets no held-out day fails the job by name: predictions are joined once, from the
    left, and a group without a point raises where its metrics are made. ``by`` columns that the actuals have too (a variant)
    are matched as well."""
    own = [c for c in by if c in actuals.columns]
    a = _norm_dates(actuals.select(*own, "series", "date", F.col("actual").cast("double").alias("actual"), F.lit(True).alias("_hit")))
    j = _norm_dates(preds).join(a, [*own, *KEYS], "left")
    m = j.groupBy(*by).agg(*metric_columns(levels, F.col("_hit")))
    name = F.concat_ws("/", *[F.col(c).cast("string") for c in by])
    lost = F.raise_error(F.concat(F.lit("nothing to score for "), name, F.lit(": its predictions meet none of the held-out days")))
    return m.withColumn("n_points", F.when(F.col("n_points") > 0, F.col("n_points")).otherwise(lost.cast("long")))


def require_overlap(metrics: DataFrame, preds: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """The metrics, checked: raises and names every group of ``preds`` (a model,
    or a variant's model) that the scorer dropped because none of its
    predictions met an actual. Only group names reach the driver. For metrics at hand; ``evaluate_checked`` needs no
    second look at the predictions."""
    scored = metrics.where(F.col("n_points") > 0).select(*by)
    lost = preds.select(*by).distinct().join(scored, list(by), "left_anti").orderBy(*by).collect()
    if lost:
        names = "; ".join("/".join(str(v) for v in r) for r in lost)
        raise ValueError(f"nothing to score for {names}: their predictions meet none of the held-out days")
    return metrics
