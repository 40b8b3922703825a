"""Daily per-series panel build (TB1-TB4) as one lazy DataFrame plan.

Shuffle map (what moves at scale):

* ``top_series``   partial count per series, final count, TakeOrderedAndProject
                    -> at most ``top_n`` rows; broadcast is bounded by config.
* ``daily_panel``  semi-join to the broadcast top-N, partial+final aggregate on
                    (series, day): output bounded by series x days, not events.
* ``gap_fill``     one shuffle by series, then a window emits each missing day
                    (``explode(sequence)``) -- no join, no all-pairs.
* ``modal_id``     aggregate on (series, id), then a per-series row_number = 1
                    planned as WindowGroupLimit (partial limit before the shuffle).
* covariates       weather (days in the year window) is broadcast; modal ids and
                    metadata semi-joined to those ids meet by id (a row per
                    series) and join the observed days by series, before these
                    are multiplied: no join moves the gap-filled panel.
* ``id_counts``     events per (series, id): one pass over the facts that gives
                    both the top-N series and the modal ids (its exchange is
                    reused); the daily aggregate is the only other pass.
* ``build_prepped`` global max day as a scalar subquery over the written source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import TEST, TRAIN, VALIDATE, PanelConfig
from ..functions.scalar import (
    date_window,
    day_of_week,
    indicator,
    is_weekend,
    month,
    safe_ratio,
    to_day,
    valid_key,
    zero_if_null,
)
from ..schemas import MEASURES, conform, prepped_schema, source_schema
from ..sources.scans import scan_weather

SERIES = "series"  # column name of the series key in the canonical trips frame


def id_counts(trips: DataFrame) -> DataFrame:
    """Events per (series, id) over the whole fact table, valid series only."""
    return trips.where(valid_key(SERIES)).groupBy(SERIES, "start_station_id").agg(F.count(F.lit(1)).alias("cnt"))


# -- AG1 --------------------------------------------------------------------
def top_series(trips: DataFrame, cfg: PanelConfig, counts: DataFrame | None = None) -> DataFrame:
    """Top-N series by row count over the whole fact table (no date filter).

    Ties at the cut are broken by series name so every engine agrees.
    ``top_n=None`` keeps every valid series (then no top-N frame is needed
    downstream: ``restrict_to`` only drops invalid keys).
    """
    if counts is None:
        counts = trips.where(valid_key(SERIES)).groupBy(SERIES).agg(F.count(F.lit(1)).alias("n_rows"))
    else:
        counts = counts.groupBy(SERIES).agg(F.sum("cnt").alias("n_rows"))
    if cfg.top_n is None:
        return counts
    return counts.orderBy(F.desc("n_rows"), F.asc(SERIES)).limit(cfg.top_n)


# -- JN1 --------------------------------------------------------------------
def restrict_to(trips: DataFrame, top: DataFrame | None) -> DataFrame:
    """Semi-join the facts to the selected keys (AQE broadcasts the keys when
    their measured size allows). ``None``: all valid keys, no join."""
    if top is None:
        return trips.where(valid_key(SERIES))
    return trips.join(top.select(SERIES), SERIES, "left_semi")


def top_or_all(trips: DataFrame, cfg: PanelConfig, counts: DataFrame | None = None) -> DataFrame | None:
    return None if cfg.top_n is None else top_series(trips, cfg, counts)


# -- AG2 (+PR2-PR5) ------------------------------------------------------------
def daily_panel(trips: DataFrame, top: DataFrame | None, cfg: PanelConfig) -> DataFrame:
    """Per (series, day): count, mean duration, subscriber share, male ratio."""
    facts = restrict_to(trips, top)
    window = date_window("starttime", cfg.date_start, cfg.date_end)
    if window is not None:
        facts = facts.where(window)
    gender = F.col("gender")
    return facts.groupBy(F.col(SERIES).alias(cfg.series_column), to_day("starttime").alias(cfg.time_column)).agg(
        F.count(F.lit(1)).alias(cfg.target_column),
        F.avg("tripduration").alias("avg_tripduration"),
        F.avg(indicator(F.col("usertype") == F.lit("Subscriber"))).alias("pct_subscriber"),
        safe_ratio(F.count_if(gender == F.lit("male")), F.count_if(gender.isin("male", "female"))).alias(
            "ratio_gender"
        ),
    )


# -- AG3 --------------------------------------------------------------------
def series_bounds(daily: DataFrame, cfg: PanelConfig) -> DataFrame:
    """(series, first_day, last_day, n_days): what gap filling completes each series to."""
    t = cfg.time_column
    ends = daily.groupBy(cfg.series_column).agg(F.min(t).alias("first_day"), F.max(t).alias("last_day"))
    return ends.withColumn("n_days", (F.datediff("last_day", "first_day") + 1).cast("long"))


# -- TB2 (JN3 -> JN2 -> PR6) ---------------------------------------------------
def gap_fill(daily: DataFrame, cfg: PanelConfig, attributes: DataFrame | None = None) -> DataFrame:
    """Zero-fill each series' missing days inside its *own* [first, last] day.

    Only the target is filled; the other measures stay NULL on filled days. One
    shuffle by series; each observed day emits itself plus the days up to the
    next observed day. ``attributes`` (one row per series) are joined to the
    observed days, before these are multiplied, and stand on every day.
    """
    s, t, y = cfg.series_column, cfg.time_column, cfg.target_column
    extra = [] if attributes is None else [c for c in attributes.columns if c != s]

    def described(df: DataFrame) -> DataFrame:
        # a hash join by series: its days keep their place and order
        return df if attributes is None else df.join(attributes.hint("shuffle_hash"), s, "left")

    if not cfg.gap_fill:
        return described(daily).select(s, t, y, *MEASURES, *extra)
    w = Window.partitionBy(s).orderBy(t)
    upto = F.coalesce(F.date_sub(F.col("_next"), 1), F.col(t))
    stepped = described(daily.withColumn("_next", F.lead(t).over(w))).select(
        s, y, *MEASURES, *extra, F.posexplode(F.sequence(F.col(t), upto)).alias("_k", t)
    )
    first = F.col("_k") == F.lit(0)
    return stepped.select(
        s,
        t,
        F.when(first, F.col(y)).otherwise(F.lit(0)).cast("long").alias(y),
        *[F.when(first, F.col(m)).alias(m) for m in MEASURES],
        *extra,
    )


# -- AG4 / WN1 ----------------------------------------------------------------
def modal_id(trips: DataFrame, top: DataFrame | None, cfg: PanelConfig, counts: DataFrame | None = None) -> DataFrame:
    """Most frequent id per series (whole fact table, no date filter).

    Ties: smaller id first; a NULL id wins only with a strictly larger count.
    """
    counts = restrict_to(id_counts(trips) if counts is None else counts, top)
    w = Window.partitionBy(SERIES).orderBy(F.desc("cnt"), F.asc_nulls_last("start_station_id"))
    ranked = counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return ranked.select(F.col(SERIES).alias(cfg.series_column), F.col("start_station_id").alias("station_id"))


# -- SC3 + JN6 prep ------------------------------------------------------------
def meta_for(meta: DataFrame, modal: DataFrame) -> DataFrame:
    """Dimension rows for the panel's ids only, one row per id.

    Semi-joined to the <= top_n modal ids first, so what gets broadcast later is
    bounded by top_n whatever the size of the dimension. Duplicate ids are
    resolved deterministically (smallest row).
    """
    ids = modal.select(F.col("station_id").cast("string").alias("station_id")).where(F.col("station_id").isNotNull())
    m = meta.join(ids, "station_id", "left_semi")  # AQE broadcasts the id list when it is small
    best = m.groupBy("station_id").agg(
        F.min(F.struct("capacity", "region_id", "latitude", "longitude")).alias("_m")
    )
    return best.select("station_id", "_m.capacity", "_m.region_id", "_m.latitude", "_m.longitude")


# -- TB1 --------------------------------------------------------------------
def build_daily(trips: DataFrame, cfg: PanelConfig) -> DataFrame:
    """AG1 -> JN1 -> AG2: the daily aggregate of the selected series."""
    return daily_panel(trips, top_or_all(trips, cfg, id_counts(trips)), cfg)


def build_source(
    trips: DataFrame | None, weather_raw: DataFrame, meta: DataFrame, cfg: PanelConfig, daily: DataFrame | None = None,
    counts: DataFrame | None = None, buckets: int | None = None,
) -> DataFrame:
    """AG1 -> JN1 -> AG2 -> AG4/WN1 -> JN5/JN6 -> TB2 -> JN4 -> PR9, one lazy plan. With ``daily`` and ``counts`` (of a stored
    state) no facts are read. What is known by series is joined to the observed days; after the gaps are filled nothing is
    shuffled or sorted. With ``buckets`` the rows lie in so many partitions by series, each by series and day."""
    s, t, y = cfg.series_column, cfg.time_column, cfg.target_column
    counts = id_counts(trips) if counts is None else counts
    top = top_or_all(trips, cfg, counts)
    if daily is None:
        daily = daily_panel(trips, top, cfg)
    if buckets:
        daily = daily.repartition(buckets, s).sortWithinPartitions(s, t)
    weather = scan_weather(weather_raw, cfg)  # one row per day of the year window
    modal = modal_id(trips, top, cfg, counts)  # one row per series
    dims = meta_for(meta, modal)  # at most one row per series
    attributes = modal.join(  # JN5 + JN6, on the id as a string on both sides: by series, not by day
        dims.withColumnRenamed("station_id", "_meta_id"),
        F.col("station_id").cast("string") == F.col("_meta_id"),
        "left",
    ).drop("_meta_id")
    panel = gap_fill(daily, cfg, attributes).join(F.broadcast(weather), t, "left")  # JN4
    out = panel.select(
        s,
        t,
        y,
        *MEASURES,
        "temp",
        "prcp",
        day_of_week(t).alias("day_of_week"),
        month(t).alias("month"),
        is_weekend(t).alias("is_weekend"),
        "station_id",
        "capacity",
        "region_id",
        "latitude",
        "longitude",
    )
    return conform(out, source_schema(cfg))


# -- TB3 (PR10 + JN9) ----------------------------------------------------------
def split_label(t: str, max_day, cfg: PanelConfig):
    test_cut = F.date_sub(max_day, cfg.test_length)
    val_cut = F.date_sub(max_day, cfg.test_length + cfg.validate_length)
    return (
        F.when(F.col(t) > test_cut, F.lit(TEST)).when(F.col(t) > val_cut, F.lit(VALIDATE)).otherwise(F.lit(TRAIN))
    )


def global_max_day(frame: DataFrame, cfg: PanelConfig):
    """The global last day as a scalar subquery (one value; no cross join)."""
    return frame.select(F.max(cfg.time_column)).scalar()


def build_prepped(source: DataFrame, cfg: PanelConfig, max_day=None) -> DataFrame:
    """source + splits, cut off the *global* last day.

    ``max_day`` may be given (e.g. from the daily aggregate, whose last day is
    the source's last day since gap fill never extends a series); otherwise it
    is a scalar subquery over ``source`` -- cheap when source is a written table.
    """
    t = cfg.time_column
    if max_day is None:
        max_day = global_max_day(source, cfg)
    return conform(source.withColumn("splits", split_label(t, max_day, cfg)), prepped_schema(cfg))


def build_tables(trips: DataFrame, weather_raw: DataFrame, meta: DataFrame, cfg: PanelConfig) -> DataFrame:
    """TB1 + TB3 lazily: the prepped panel, cut-off from the daily aggregate."""
    daily = build_daily(trips, cfg)
    source = build_source(trips, weather_raw, meta, cfg, daily=daily)
    return build_prepped(source, cfg, max_day=global_max_day(daily, cfg))


# -- TB4 (PR11 / PR12) -----------------------------------------------------------
def build_train(prepped: DataFrame) -> DataFrame:
    """Fitting window: TRAIN and VALIDATE rows."""
    return prepped.where(F.col("splits") != F.lit(TEST))


def build_infer(prepped: DataFrame, cfg: PanelConfig) -> DataFrame:
    """TEST rows with the target typed NULL (known-future covariates kept)."""
    y = cfg.target_column
    return prepped.where(F.col("splits") == F.lit(TEST)).withColumn(y, F.lit(None).cast("long"))


# -- PR13 --------------------------------------------------------------------
def regressor_frame(frame: DataFrame, cfg: PanelConfig, roles: tuple[str, ...] | None = None) -> DataFrame:
    """series, time, target and the available-at-forecast covariates only."""
    cols = roles if roles is not None else cfg.roles.available
    missing = [c for c in cols if c not in frame.columns]
    if missing:
        raise ValueError(f"regressor columns not in frame: {missing}")
    return frame.select(cfg.series_column, cfg.time_column, cfg.target_column, *cols)
