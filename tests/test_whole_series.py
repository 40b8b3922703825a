"""Fits in one pass over whole series: against the Spark plans of the same steps, however the rows come."""

from __future__ import annotations

import datetime
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelcast.operators import panel
from panelcast.operators.forecast import arima as A
from panelcast.operators.forecast import whole_series as W
from panelcast.operators.forecast import xreg as X
from panelcast.plans.backtest import prepped_for
from panelcast.plans.common import SUPPLIER
from panelcast.session import ensure_checkpoint_dir
from panelcast.sources.tables import materialize_by_series, read_table, write_table

from .conftest import SF_SMALL
from .test_layout import plan

COLS = [*SUPPLIER.roles.available, "_holiday"]
START = datetime.date(2021, 3, 4)


@pytest.fixture(scope="module")
def train(spark):
    return panel.build_train(prepped_for(spark, SF_SMALL, "supplier", SUPPLIER))


@pytest.fixture(scope="module")
def odd(spark):
    """Series of 1 to 90 days, some flat, wandering or weekly, with gaps, unknown targets and unknown covariates."""
    rng, rows = np.random.default_rng(5), []
    for n in (1, 2, 7, 8, 9, 16, 17, 24, 25, 36, 41, 42, 43, 60, 90):
        noise = rng.normal(size=n) * 3
        for kind, y in {"flat": noise * 0, "walk": 5 + np.cumsum(noise), "week": noise * 0.3 + np.arange(n) % 7 * 4, "gaps": noise}.items():
            for i in range(n):
                if kind == "gaps" and i % 5 == 3 and n > 9:
                    continue
                d = START + datetime.timedelta(days=i)
                target = None if kind == "walk" and i % 11 == 4 else float(y[i])
                rows.append((f"{kind}{n}", d, target, None if i % 4 == 1 else float(rng.normal()), None, d.isoweekday(), d.month, int(d.isoweekday() > 5)))
    schema = "series string, date date, target double, temp double, prcp double, day_of_week long, month long, is_weekend long"
    return spark.createDataFrame(rows, schema).repartition(7)


def table(df):
    return {r["series"]: r.asDict() for r in df.collect()}


def test_the_one_pass_gives_what_the_spark_steps_give(odd):
    _, res = A.errors(odd, SUPPLIER)
    res = res.localCheckpoint()
    kinds = A.stationarity(res)
    last = A.differenced(res, kinds).groupBy("series").agg(F.max_by(F.struct("r", F.coalesce("x", F.lit(0.0)).alias("x"), F.coalesce("w", F.lit(0.0)).alias("w")), "date").alias("l"))
    ours, want, tail = table(A.fit_arima(odd, SUPPLIER)), table(kinds), table(last)
    assert set(ours) == set(want) and len(ours) > 50
    assert {r["d"] for r in want.values()} == {r["seasonal"] for r in want.values()} == {0, 1}
    for s, m in ours.items():
        assert (m["n"], m["d"], m["seasonal"]) == (want[s]["n"], want[s]["d"], want[s]["seasonal"]), s
        assert [m["kpss"], m["strength"]] == pytest.approx([want[s]["kpss"], want[s]["strength"]], rel=1e-6, abs=1e-9), s
        assert [m["last_r"], m["last_x"][0], m["last_w"][0]] == pytest.approx(list(tail[s]["l"]), abs=1e-7), s
    plain, errors = table(X.fit_xreg(odd, SUPPLIER)), table(X.error_model(res))
    assert set(plain) == set(errors)
    for s, m in plain.items():
        assert m["phi"] == pytest.approx(errors[s]["phi"], rel=1e-5, abs=1e-7) and m["last_resid"] == pytest.approx(errors[s]["last_resid"], abs=1e-7), s
        assert m["sigma"] == pytest.approx(errors[s]["sigma"], rel=1e-6, abs=1e-7), s
        assert m["beta"] == ours[s]["beta"] and m["last_date"] == ours[s]["last_date"]


@pytest.mark.parametrize("rows", [1, 50, 1 << 16])
def test_chunks_hold_whole_series_whatever_the_batches(odd, monkeypatch, rows):
    monkeypatch.setattr(W, "ROWS", rows)
    frame = X._feature_frame(odd, SUPPLIER, list(SUPPLIER.roles.available)).where(F.col("y").isNotNull())
    whole = pa.Table.from_pandas(W.laid(frame).coalesce(1).toPandas(), preserve_index=False)
    parts = [A._sums(c, COLS, X.RIDGE) for c in W.chunks(iter(whole.to_batches(max_chunksize=13)))]
    got, want = W.joined(parts), A._sums(W.Chunk(whole), COLS, X.RIDGE)
    assert got["series"].equals(want["series"]) and (rows > 50 or len(parts) > 3)
    for k, v in want.items():
        if k not in ("series", "last_date"):
            assert np.allclose(got[k], v, rtol=1e-12, atol=1e-12), k


def test_a_fit_reads_the_stored_panel_once_and_writes_its_model_alone(spark, train, tmp_path):
    frame = X._feature_frame(train, SUPPLIER, list(SUPPLIER.roles.available))
    text = plan(W.laid(frame))
    assert "Exchange" not in text and "Sort [" not in text and text.count("FileScan") == 1
    stored = f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/materialized"
    tables = lambda: set(os.listdir(stored)) if os.path.isdir(stored) else set()
    before, limit = tables(), spark.conf.get(W.BATCH_BYTES)
    A.fit_arima(train, SUPPLIER, model_path=f"{tmp_path}/arima")
    X.fit_xreg(train, SUPPLIER, model_path=f"{tmp_path}/xreg")
    assert tables() == before
    assert spark.conf.get(W.BATCH_BYTES) == limit


def test_series_stay_whole_where_files_are_split(spark, train, tmp_path):
    want = table(A.fit_arima(train, SUPPLIER))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = table(A.fit_arima(train, SUPPLIER))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want


def test_no_number_is_unknown_and_not_a_series_without_errors():
    pdf = pd.DataFrame({"series": ["a", "b"], "v": [np.nan, 1.0]})
    schema = pa.schema({"series": pa.string(), "m": pa.list_(pa.float64()), "v": pa.float64()})
    out = W.record({"series": pa.array(pdf["series"]), "m": np.array([[np.nan, 2.0], [3.0, 4.0]]), "v": pdf["v"].to_numpy()}, schema)
    assert out.to_pylist() == [{"series": "a", "m": [None, 2.0], "v": None}, {"series": "b", "m": [3.0, 4.0], "v": 1.0}]


def test_a_clustered_table_without_rows_is_read_back(spark, tmp_path):
    day, nested = F.date_add(F.lit(START), F.col("id").cast("int")), F.array(F.struct(F.col("id").cast("int").alias("a"), F.lit(None).cast("string").alias("b")))
    none = spark.range(9).where("id > 9").select(F.col("id").cast("string").alias("series"), day.alias("date"), F.col("id").cast("double").alias("r"), nested.alias("v"))
    assert write_table(none, f"{tmp_path}/none", cluster_by="series", sort_by="date") == 0
    back = read_table(spark, f"{tmp_path}/none")
    assert [(f.name, f.dataType.simpleString()) for f in back.schema.fields] == [(f.name, f.dataType.simpleString()) for f in none.schema.fields]
    assert back.collect() == []
    empty = materialize_by_series(none.select("series", "date", "r"), "empty-errors")
    assert empty.count() == A.stationarity(empty).count() == 0
