"""The stored panel's layout: what grows with series x days is neither shuffled nor sorted again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelcast.config import PanelConfig
from panelcast.operators import contexts, panel
from panelcast.operators.forecast import arima, xreg
from panelcast.plans.backtest import prepped_for, source_path
from panelcast.plans.common import SUPPLIER
from panelcast.sources import adapters
from panelcast.sources.tables import materialize_by_series, read_table

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def prepped(spark):
    return prepped_for(spark, SF_SMALL, "supplier", SUPPLIER)


def test_no_join_or_exchange_moves_the_gap_filled_panel(spark):
    trips, weather, meta, _ = adapters.adapter_inputs(spark, SF_SMALL, "supplier")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the series' attributes are too many to broadcast
    try:
        text = plan(panel.build_source(trips, weather, meta, SUPPLIER, buckets=4))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = text[: text.index("Generate explode") if "Generate explode" in text else text.index("Generate posexplode")]
    assert "Exchange hashpartitioning" not in above and "Sort " not in above and "SortMergeJoin" not in above


def test_a_bucket_is_one_file_in_order_of_series_and_day(spark, prepped):
    base = source_path(spark, SF_SMALL, "supplier", SUPPLIER)
    files = [f for f in read_table(spark, base).inputFiles()]
    assert files and len({f.rsplit("_", 1)[1] for f in files}) == len(files)
    for f in files:
        rows = [(r["series"], r["date"]) for r in spark.read.parquet(f).select("series", "date").toLocalIterator()]
        assert rows == sorted(rows)


def test_contexts_and_fits_need_no_sort(spark, prepped):
    train = panel.build_train(prepped)
    ctx = plan(contexts.series_contexts(prepped, SUPPLIER))
    assert "Exchange" not in ctx and "Sort [" not in ctx
    assert "Sort [" not in plan(arima.errors(train, SUPPLIER)[1])
    res = materialize_by_series(arima.errors(train, SUPPLIER)[1], "layout-errors")
    kinds = plan(arima.stationarity(res))
    assert "Exchange" not in kinds and "Sort [" not in kinds
    assert res.count() == arima.errors(train, SUPPLIER)[1].count() == xreg._features(train, SUPPLIER, list(SUPPLIER.roles.available))[0].count()


def test_contexts_keep_the_last_rows_with_gaps_and_short_series(spark):
    cfg = PanelConfig(context_len=3, gap_fill=False)
    rows = [("a", f"2024-01-{d:02d}", d, "TRAIN") for d in (1, 5, 6, 20)] + [("b", "2024-01-09", 7, "TRAIN"), ("a", "2024-01-21", 9, "TEST")]
    df = spark.createDataFrame(rows, "series string, date string, target long, splits string").withColumn("date", F.to_date("date"))
    got = {r["series"]: (r["context"], str(r["last_date"]), r["n"]) for r in contexts.series_contexts(df, cfg).collect()}
    assert got == {"a": ([5.0, 6.0, 20.0], "2024-01-20", 3), "b": ([7.0], "2024-01-09", 1)}
