"""Per-point error expressions shared by every scorer (one definition, all models)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import QUANTILES, quantile_column


def _nan_if_null(c: Column) -> Column:
    # A missing value must poison the mean (as NaN does in numpy), not be skipped.
    return F.coalesce(c.cast("double"), F.lit(float("nan")))


def abs_error(forecast: Column, actual: Column) -> Column:
    return F.abs(_nan_if_null(forecast) - _nan_if_null(actual))


def sq_error(forecast: Column, actual: Column) -> Column:
    e = _nan_if_null(forecast) - _nan_if_null(actual)
    return e * e


def smape_term(forecast: Column, actual: Column) -> Column:
    """|f - a| / ((|a| + |f|)/2), 0 where both are 0 (the division is guarded)."""
    f, a = _nan_if_null(forecast), _nan_if_null(actual)
    denom = (F.abs(a) + F.abs(f)) / F.lit(2.0)
    return F.when(denom == F.lit(0.0), F.lit(0.0)).otherwise(F.abs(f - a) / denom)


def pinball_term(pred: Column, actual: Column, level: float) -> Column:
    d = _nan_if_null(actual) - _nan_if_null(pred)
    return F.greatest(F.lit(level) * d, F.lit(level - 1.0) * d)


def mean_pinball_term(actual: Column, levels=QUANTILES) -> Column:
    """Mean pinball loss of one point over the levels (levels equally weighted,
    so the mean of these per-point means is the mean over points x levels)."""
    if not levels:
        return F.lit(0.0)
    total = None
    for q in levels:
        t = pinball_term(F.col(quantile_column(q)), actual, q)
        total = t if total is None else total + t
    return total / F.lit(float(len(levels)))
