"""Registered queries of the panel layer (TB1-TB4 and their parts)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import daily_state
from ..operators import panel as P
from ..session import shared_path
from ..sources import adapters as A
from ..sources.scans import scan_weather
from .backtest import prepped_for
from .common import NATION, SUPPLIER, SUPPLIER_TOP10, USER, rounded
from .oracle_sql import SOURCE_COLS, r, with_panel
from .registry import register


def _inputs(spark, sf_dir, adapter):
    trips, weather_raw, meta, _ = A.adapter_inputs(spark, sf_dir, adapter)
    return trips, weather_raw, meta


def source_of(spark, sf_dir, adapter, cfg):
    trips, weather_raw, meta = _inputs(spark, sf_dir, adapter)
    return P.build_source(trips, weather_raw, meta, cfg)


# AG1: top-k report (the limit is the feature); tie at the cut broken by name.
@register(
    "top_series",
    with_panel("supplier", "SELECT series, n_rows FROM top", SUPPLIER_TOP10),
)
def q_top_series(spark, sf_dir):
    trips = A.supplier_trips(spark, sf_dir)
    return P.top_series(trips, SUPPLIER_TOP10)


# JN1 + AG2: daily aggregate, all suppliers.
@register(
    "daily_panel",
    with_panel(
        "supplier",
        f"SELECT series, date, target, {r('avg_tripduration')} AS avg_tripduration, "
        f"{r('pct_subscriber')} AS pct_subscriber, {r('ratio_gender')} AS ratio_gender FROM daily",
        SUPPLIER,
    ),
)
def q_daily_panel(spark, sf_dir):
    trips = A.supplier_trips(spark, sf_dir)
    top = P.top_or_all(trips, SUPPLIER)
    return rounded(P.daily_panel(trips, top, SUPPLIER))


# TB2: gap fill over each series' own window, all suppliers.
@register(
    "gap_filled_panel",
    with_panel(
        "supplier",
        f"SELECT series, date, target, {r('avg_tripduration')} AS avg_tripduration, "
        f"{r('pct_subscriber')} AS pct_subscriber, {r('ratio_gender')} AS ratio_gender FROM filled",
        SUPPLIER,
    ),
)
def q_gap_filled(spark, sf_dir):
    trips = A.supplier_trips(spark, sf_dir)
    top = P.top_or_all(trips, SUPPLIER)
    return rounded(P.gap_fill(P.daily_panel(trips, top, SUPPLIER), SUPPLIER))


# AG3: the days each series is completed to, all suppliers.
@register(
    "series_bounds",
    with_panel(
        "supplier",
        "SELECT series, MIN(date) AS first_day, MAX(date) AS last_day, CAST(MAX(date) - MIN(date) + 1 AS BIGINT) AS n_days FROM daily GROUP BY series",
        SUPPLIER,
    ),
)
def q_series_bounds(spark, sf_dir):
    trips = A.supplier_trips(spark, sf_dir)
    return P.series_bounds(P.daily_panel(trips, P.top_or_all(trips, SUPPLIER), SUPPLIER), SUPPLIER)


# TB1 + TB5: the source table from a state that took in the facts in two updates; the second reads the new files alone.
@register("incremental_panel", with_panel("supplier", f"SELECT {SOURCE_COLS} FROM source", SUPPLIER))
def q_incremental(spark, sf_dir):
    base = shared_path(spark, "state", uuid.uuid4().hex[:12])
    facts, root = f"{base}/facts", f"{base}/state"
    lineitem = A.read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice", "l_returnflag", "l_linestatus")
    late = F.col("l_shipdate") >= F.lit("1997-01-01").cast("date")
    trips = lambda f: A.supplier_trips(spark, sf_dir, f, (daily_state.FILE,))
    lineitem.where(~late).write.parquet(facts)
    daily_state.update(spark, facts, root, trips)
    lineitem.where(late).write.mode("append").parquet(facts)
    daily_state.update(spark, facts, root, trips)
    state = daily_state.current(spark, facts, root)
    counts = daily_state.id_counts(state)
    daily = daily_state.daily(state, P.top_or_all(None, SUPPLIER, counts), SUPPLIER)
    _, weather_raw, meta = _inputs(spark, sf_dir, "supplier")
    return rounded(P.build_source(None, weather_raw, meta, SUPPLIER, daily=daily, counts=counts))


# SC2 + PR7 + PR8: covariate scan, one row per day.
@register("weather_clean", with_panel("nation", f"SELECT date, {r('temp')} AS temp, {r('prcp')} AS prcp FROM weather"))
def q_weather(spark, sf_dir):
    return rounded(scan_weather(A.weather_shards(spark, sf_dir), NATION))


# AG4 / WN1: modal id per series, all suppliers (id = part key).
@register("modal_id", with_panel("supplier", "SELECT series, station_id FROM modal", SUPPLIER))
def q_modal(spark, sf_dir):
    trips = A.supplier_trips(spark, sf_dir)
    top = P.top_or_all(trips, SUPPLIER)
    return P.modal_id(trips, top, SUPPLIER)


# TB1: the full source table (nation adapter).
@register("source_table", with_panel("nation", f"SELECT {SOURCE_COLS} FROM source"))
def q_source(spark, sf_dir):
    return rounded(source_of(spark, sf_dir, "nation", NATION))


# TB1 on the user adapter (no id column, short histories).
@register("source_table_user", with_panel("user", f"SELECT {SOURCE_COLS} FROM source", USER))
def q_source_user(spark, sf_dir):
    return rounded(source_of(spark, sf_dir, "user", USER))


# TB3: splits off the global max day; suppliers include series ending early.
@register(
    "prepped_splits",
    with_panel("supplier", f"SELECT {SOURCE_COLS}, splits FROM prepped", SUPPLIER),
)
def q_prepped(spark, sf_dir):
    return rounded(prepped_for(spark, sf_dir, "supplier", SUPPLIER))


# TB4: train (TRAIN + VALIDATE rows).
@register("train_table", with_panel("nation", f"SELECT {SOURCE_COLS}, splits FROM train"))
def q_train(spark, sf_dir):
    return rounded(P.build_train(prepped_for(spark, sf_dir, "nation", NATION)))


# TB4: infer (TEST rows, target typed NULL).
@register("infer_table", with_panel("nation", f"SELECT {SOURCE_COLS}, splits FROM infer"))
def q_infer(spark, sf_dir):
    return rounded(P.build_infer(prepped_for(spark, sf_dir, "nation", NATION), NATION))


# PR13: role-based column selection for the regression model.
@register(
    "regressor_frame",
    with_panel("nation", f"SELECT series, date, target, {r('temp')} AS temp, {r('prcp')} AS prcp, "
               "day_of_week, month, is_weekend FROM train"),
)
def q_regressors(spark, sf_dir):
    return rounded(P.regressor_frame(P.build_train(prepped_for(spark, sf_dir, "nation", NATION)), NATION))



# PR2: daily aggregate inside a date window (inclusive bounds on the raw timestamp).
WINDOWED = SUPPLIER.replace(date_start="1995-01-15", date_end="1996-06-30")


@register(
    "windowed_daily_panel",
    with_panel(
        "supplier",
        f"SELECT series, date, target, {r('avg_tripduration')} AS avg_tripduration, "
        f"{r('pct_subscriber')} AS pct_subscriber, {r('ratio_gender')} AS ratio_gender FROM daily",
        WINDOWED,
    ),
)
def q_windowed_daily(spark, sf_dir):
    trips = A.supplier_trips(spark, sf_dir)
    return rounded(P.daily_panel(trips, P.top_or_all(trips, WINDOWED), WINDOWED))
