"""What is known of a future day (JN10): calendar and holiday follow from the date, the day's own row (weather) and the series'
attributes come from the panel. Only what neither gives stays NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...config import PanelConfig
from ...functions import scalar
from .holidays import holiday_flag

#: Covariates that are a function of the date.
CALENDAR = {"day_of_week": scalar.day_of_week, "month": scalar.month, "is_weekend": scalar.is_weekend}


def known_of_day(cfg: PanelConfig) -> list[Column]:
    """k_* (known ahead), k_holiday and a_* (attributes) of a panel row."""
    return [
        *[F.col(c).cast("double").alias(f"k_{c}") for c in cfg.roles.available],
        holiday_flag(cfg.time_column, cfg.holiday_region).cast("double").alias("k_holiday"),
        *[F.col(c).cast("double").alias(f"a_{c}") for c in cfg.roles.attribute],
    ]


def by_date(panel: DataFrame, cfg: PanelConfig, columns: list[str]) -> DataFrame:
    """(date, columns): of each day any known value -- for covariates that all series share, such as the weather."""
    t = cfg.time_column
    return panel.groupBy(F.col(t).alias("date")).agg(*[F.max(F.col(c).cast("double")).alias(c) for c in columns])


def with_covariates(steps: DataFrame, panel: DataFrame, cfg: PanelConfig, names: list[str]) -> DataFrame:
    """``steps`` (series, date, ...) with the covariates ``names`` of each day (JN10)."""
    s, t = cfg.series_column, cfg.time_column
    missing = [c for c in names if c not in CALENDAR and c not in panel.columns]
    if missing:
        raise ValueError(f"regressors missing from the frame: {missing}")
    free = [c for c in names if c not in CALENDAR]
    out = steps
    if free:
        own = panel.select(F.col(s).alias("series"), F.col(t).alias("date"), *[F.col(c).cast("double").alias(f"own_{c}") for c in free])
        days = by_date(panel, cfg, free).select("date", *[F.col(c).alias(f"day_{c}") for c in free])
        out = out.join(own, ["series", "date"], "left").join(days, "date", "left")
    known = [(CALENDAR[c]("date").cast("double") if c in CALENDAR else F.coalesce(f"own_{c}", f"day_{c}")).alias(c) for c in names]
    return out.select(*steps.columns, *known)


def future_days(ends: DataFrame, panel: DataFrame, cfg: PanelConfig, horizon: int | None = None) -> DataFrame:
    """``ends`` (series, last_date, ...) by step: series, date, h, the other columns of ``ends`` and the features of
    ``known_of_day``."""
    rest = [c for c in ends.columns if c not in ("series", "last_date")]
    names, attributes = list(cfg.roles.available), list(cfg.roles.attribute)
    steps = ends.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon or cfg.horizon))).alias("h"))
    steps = steps.select("series", F.date_add("last_date", F.col("h")).alias("date"), "h", *rest)
    out = with_covariates(steps, panel, cfg, names)
    if attributes:
        own = panel.groupBy(F.col(cfg.series_column).alias("series")).agg(*[F.max(F.col(c).cast("double")).alias(f"a_{c}") for c in attributes])
        out = out.join(own, "series", "left")
    return out.select(
        "series", "date", "h", *rest, *[F.col(c).alias(f"k_{c}") for c in names],
        holiday_flag("date", cfg.holiday_region).cast("double").alias("k_holiday"), *[F.col(f"a_{c}") for c in attributes],
    )
