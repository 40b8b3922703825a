"""Panel build invariants on the small test tables."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.config import PanelConfig
from panelcast.operators import panel
from panelcast.sources import adapters
from panelcast.sources.scans import scan_weather

from .conftest import SF_SMALL


def test_gap_fill_properties(spark):
    trips = adapters.supplier_trips(spark, SF_SMALL)
    cfg = adapters.ADAPTER_CONFIGS["supplier"].replace(top_n=None)
    daily = panel.build_daily(trips, cfg)
    filled = panel.gap_fill(daily, cfg)
    assert filled.count() == panel.series_bounds(daily, cfg).agg(F.sum("n_days")).first()[0]
    assert filled.agg(F.sum("target")).first()[0] == trips.count()
    # row for row by pandas
    own = daily.toPandas()
    own["date"] = pd.to_datetime(own["date"])
    parts = []
    for name, g in own.groupby("series"):
        g = g.set_index("date").asfreq("D")
        parts.append(g.assign(series=name, target=g["target"].fillna(0).astype(int)).reset_index())
    want = pd.concat(parts)[list(filled.columns)]
    got = filled.toPandas()
    got["date"] = pd.to_datetime(got["date"])
    pd.testing.assert_frame_equal(
        got.sort_values(["series", "date"]).reset_index(drop=True), want.sort_values(["series", "date"]).reset_index(drop=True), check_dtype=False
    )
    # filled days keep NULL measures
    zero = filled.where("target = 0").select("avg_tripduration").distinct().collect()
    assert all(r[0] is None for r in zero)


def test_result_independent_of_partitioning(spark):
    trips = adapters.nation_trips(spark, SF_SMALL)
    cfg = adapters.ADAPTER_CONFIGS["nation"]
    w, m = adapters.weather_shards(spark, SF_SMALL), adapters.customer_meta(spark, SF_SMALL)
    a = sorted(map(tuple, panel.build_tables(trips, w, m, cfg).collect()))
    b = sorted(map(tuple, panel.build_tables(trips.repartition(13), w.repartition(3), m, cfg).collect()))
    assert a == b


def test_top_n_tie_break_by_name(spark):
    df = spark.createDataFrame(
        [("b",), ("b",), ("a",), ("a",), ("c",), ("",), ("",), ("",), (None,), (None,), (None,)], "series string"
    )
    top = panel.top_series(df, PanelConfig(top_n=2)).collect()
    assert [r["series"] for r in top] == ["a", "b"]


def test_weather_sentinels_and_window(spark):
    raw = spark.createDataFrame(
        [
            ("2014", "01", "02", "S", "W", 9999.9, 0.5),
            ("2014", "01", "03", "S", "W", 30.0, 99.99),
            ("2012", "01", "03", "S", "W", 1.0, 1.0),
            ("2014", "01", "04", "X", "W", 1.0, 1.0),
        ],
        "year string, mo string, da string, stn string, wban string, temp double, prcp double",
    )
    from panelcast.config import WeatherSpec

    cfg = PanelConfig(weather=WeatherSpec(stn="S", wban="W"))
    rows = {str(r["date"]): r for r in scan_weather(raw, cfg).collect()}
    assert set(rows) == {"2014-01-02", "2014-01-03"}
    assert rows["2014-01-02"]["temp"] is None and rows["2014-01-03"]["prcp"] is None


def test_weather_partition_pruning(spark, tmp_path):
    raw = adapters.weather_shards(spark, SF_SMALL)
    path = str(tmp_path / "weather")
    raw.write.partitionBy("year").parquet(path)
    cfg = adapters.ADAPTER_CONFIGS["nation"].replace(date_start="1996-01-01", date_end="1997-12-31")
    df = scan_weather(spark.read.parquet(path), cfg)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    years = {r["date"].year for r in df.collect()}
    assert years <= {1996, 1997}


def test_date_window_pushed_to_scan(spark):
    trips = adapters.supplier_trips(spark, SF_SMALL)
    cfg = adapters.ADAPTER_CONFIGS["supplier"].replace(top_n=None, date_start="1996-01-01", date_end="1996-12-31")
    daily = panel.build_daily(trips, cfg)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    days = daily.agg(F.min("date"), F.max("date")).first()
    assert str(days[0]) >= "1996-01-01" and str(days[1]) <= "1996-12-31"


def test_splits_from_global_max(spark):
    trips = adapters.supplier_trips(spark, SF_SMALL)
    cfg = adapters.ADAPTER_CONFIGS["supplier"].replace(top_n=None)
    p = panel.build_tables(trips, adapters.weather_shards(spark, SF_SMALL), adapters.customer_meta(spark, SF_SMALL), cfg)
    mx = p.agg(F.max("date")).first()[0]
    test_days = p.where("splits = 'TEST'").select("date").distinct().count()
    assert test_days <= cfg.test_length
    assert p.where("splits = 'TEST'").agg(F.min("date")).first()[0] > mx - __import__("datetime").timedelta(days=cfg.test_length)
    infer = panel.build_infer(p, cfg)
    assert infer.where(F.col("target").isNotNull()).count() == 0
    assert panel.build_train(p).where("splits = 'TEST'").count() == 0


@pytest.mark.parametrize("adapter", ["nation", "supplier", "user"])
def test_source_schema(spark, adapter):
    from panelcast.schemas import source_schema

    trips, w, m, cfg = adapters.adapter_inputs(spark, SF_SMALL, adapter)
    src = panel.build_source(trips, w, m, cfg)
    assert [(f.name, f.dataType) for f in src.schema.fields] == [(f.name, f.dataType) for f in source_schema(cfg).fields]


def test_stored_panel_is_built_once_and_read_without_facts(spark):
    from panelcast.plans.backtest import prepped_for

    first = prepped_for(spark, SF_SMALL, "nation")
    again = prepped_for(spark, SF_SMALL, "nation")
    assert sorted(first.inputFiles()) == sorted(again.inputFiles())
    plan = again.select("series")._jdf.queryExecution().optimizedPlan().toString()
    assert "o_custkey" not in plan and "l_shipdate" not in plan


def test_top_and_modal_ids_share_one_pass_over_the_facts(spark):
    trips, w, m, cfg = adapters.adapter_inputs(spark, SF_SMALL, "supplier")
    cfg = cfg.replace(top_n=5)
    counts = panel.id_counts(trips)
    top = panel.top_series(trips, cfg, counts)
    assert top.collect() == panel.top_series(trips, cfg).collect()
    a = panel.modal_id(trips, top, cfg, counts).orderBy("series").collect()
    assert a == panel.modal_id(trips, top, cfg).orderBy("series").collect()


def test_stored_panel_is_read_without_an_exchange_by_series(spark):
    """Contexts, the per-series fit and per-series scores of the stored, bucketed panel group by series where its rows lie."""
    from pyspark.sql import functions as F

    from panelcast.operators import contexts, panel, score
    from panelcast.operators.forecast import xreg
    from panelcast.plans.backtest import prepped_for
    from panelcast.plans.common import SUPPLIER
    from panelcast.sources.scans import actuals

    prepped = prepped_for(spark, SF_SMALL, "supplier", SUPPLIER)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # at scale the means of all series are no broadcast
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(contexts.series_contexts(prepped, SUPPLIER))
    assert "Exchange" not in plan(xreg.gram_rows(panel.build_train(prepped), SUPPLIER, ["temp"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    acts = actuals(prepped, SUPPLIER)
    own = acts.select("series", "date", F.col("actual").alias("forecast"), *[F.col("actual").alias(q) for q in ("q10", "q30", "q50", "q70", "q90")], F.lit("m").alias("model"))
    per = own.groupBy("series").agg(F.avg("forecast"))
    assert "Exchange" not in plan(per)
    assert score.evaluate_per_series(own, acts).count() == acts.select("series").distinct().count()


def test_changed_code_or_input_makes_another_table(spark, tmp_path, monkeypatch):
    import shutil

    from panelcast.plans import backtest
    from panelcast.plans.common import NATION

    one = backtest.source_fingerprint(spark, SF_SMALL, "nation", NATION)
    assert one == backtest.source_fingerprint(spark, SF_SMALL, "nation", NATION)
    copy = str(tmp_path / "in")
    shutil.copytree(SF_SMALL, copy)
    assert backtest.source_fingerprint(spark, copy, "nation", NATION) != one
    monkeypatch.setattr(backtest, "BUILD_CODE", (backtest,))
    assert backtest.source_fingerprint(spark, SF_SMALL, "nation", NATION) != one


def test_clustered_table_keeps_rows_and_observed_values(spark, tmp_path):
    from pyspark.sql import functions as F

    from panelcast.sources.tables import read_table, table_properties, write_table

    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("series"), "id")
    path = str(tmp_path / "t")
    assert write_table(df, path, observed={"most": F.max("id")}, cluster_by="series", sort_by="id") == 100
    back = read_table(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert table_properties(spark, path)["most"] == "99" and spark.catalog.listTables() == []
    assert write_table(back.where("id < 5"), path, cluster_by="series") == 5 and read_table(spark, path).count() == 5


def test_state_reads_new_files_alone_and_equals_a_full_build(spark, tmp_path):
    import glob
    import os

    from panelcast.operators import daily_state as D

    cfg = adapters.ADAPTER_CONFIGS["supplier"]
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    facts, root = str(tmp_path / "facts"), str(tmp_path / "state")
    w, m = adapters.weather_shards(spark, SF_SMALL), adapters.customer_meta(spark, SF_SMALL)
    trips = lambda f: adapters.supplier_trips(spark, SF_SMALL, f, (D.FILE,))

    def rows(df):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)

    def incremental():
        state = D.current(spark, facts, root)
        counts = D.id_counts(state)
        top = panel.top_or_all(None, cfg, counts)
        return rows(panel.build_source(None, w, m, cfg, daily=D.daily(state, top, cfg), counts=counts))

    def full():
        return rows(panel.build_source(adapters.supplier_trips(spark, SF_SMALL, spark.read.parquet(facts)), w, m, cfg))

    parts = li.randomSplit([0.5, 0.3, 0.2], 1)
    parts[0].repartition(3).write.parquet(facts)
    assert D.update(spark, facts, root, trips, lot=2) == 3 and incremental() == full()
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/rows/*/*.parquet")}
    parts[1].coalesce(1).write.mode("append").parquet(facts)
    assert D.update(spark, facts, root, trips) == 1 and incremental() == full()
    assert all(os.path.getmtime(f) == t for f, t in before.items())
    assert D.update(spark, facts, root, trips) == 0
    # rows of an update that broke off before its commit are not read; a file that went takes its rows along
    spark.read.parquet(f"{root}/rows").drop("batch").write.parquet(f"{root}/rows/batch=torn")
    assert incremental() == full()
    gone = sorted(glob.glob(f"{facts}/*.parquet"))[0]
    os.rename(gone, str(tmp_path / "gone"))
    spark.catalog.refreshByPath(facts)
    assert D.update(spark, facts, root, trips) == 0 and incremental() == full()


def _one_batch(spark, tmp_path, facts):
    from panelcast.operators import daily_state as D

    path, root = str(tmp_path / "facts"), str(tmp_path / "state")
    facts.repartition(2).write.parquet(path)
    assert D.update(spark, path, root, lambda f: f) == 2
    return D.current(spark, path, root)


def _trips(spark, rows):
    return spark.createDataFrame(rows, "series string, starttime timestamp, tripduration double, usertype string, gender string, start_station_id long")


def test_state_is_dealt_out_by_key_once_before_each_sum(spark, tmp_path, monkeypatch):
    import re
    from datetime import datetime

    from panelcast.operators import daily_state as D

    rows = [(f"s{i % 7}", datetime(2024, 1, 1 + i % 20), float(i), "Subscriber", "male", i % 11) for i in range(400)]
    state = _one_batch(spark, tmp_path, _trips(spark, rows))
    cfg = adapters.ADAPTER_CONFIGS["supplier"]
    monkeypatch.setattr(D, "PART", 100)  # the rows that one task sums

    def plan(df):
        return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")

    def keys(df):  # of the exchanges that move the state's rows, from the last to the first
        found = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(df))
        return [",".join(re.sub(r"#\d+L?", "", k).replace(" ", "").split(",")[:-1]) for k in found]

    for frame, key in ((D.daily(state, None, cfg), "series,day"), (D.id_counts(state), "series,_share")):
        text = plan(frame)
        assert [k for k in keys(frame) if "series" in k] == [key]  # summed where they arrive
        assert "file,batch" not in keys(frame) and "BroadcastHashJoin" in text and "SortMergeJoin [file" not in text
        assert text.index("HashAggregate(keys=[series") < text.index("Exchange hashpartitioning(series")
        moved = text[text.index("Exchange hashpartitioning(series"):]
        assert "HashAggregate(keys=[series" not in moved  # no sums over a whole split before the exchange
    assert D.daily(state, None, cfg).rdd.getNumPartitions() == D.id_counts(state).rdd.getNumPartitions() == 4
    more = _trips(spark, rows).repartition(1)
    more.write.mode("append").parquet(str(tmp_path / "facts"))
    assert D.update(spark, str(tmp_path / "facts"), str(tmp_path / "state"), lambda f: f) == 1
    sizes = sorted(len(list(d.glob("*.parquet"))) for d in (tmp_path / "state" / "rows").glob("batch=*"))
    assert sizes == [1, 4]
    assert D.daily(D.current(spark, str(tmp_path / "facts"), str(tmp_path / "state")), None, cfg).agg(F.sum(cfg.target_column)).first()[0] == 800


def test_state_sums_nulls_as_the_facts_do(spark, tmp_path):
    from datetime import datetime

    from panelcast.operators import daily_state as D

    day = datetime(2024, 3, 1, 23, 59)
    rows = [
        ("a", day, None, None, None, None), ("a", day, 4.0, "Subscriber", "other", None), ("a", day, 2.0, "Customer", None, 3),
        ("b", day, None, None, None, 1), ("b", None, 1.0, "Subscriber", "female", 1), (None, day, 1.0, "Subscriber", "male", 1),
        ("", day, 1.0, "Customer", "male", 1), ("c", day, 1.0, None, "male", 2), ("c", day, 3.0, "Customer", "female", None),
    ]
    trips = _trips(spark, rows)
    state = _one_batch(spark, tmp_path, trips)
    cfg = adapters.ADAPTER_CONFIGS["supplier"]

    def same(a, b):
        assert sorted(map(tuple, a.select(b.columns).collect()), key=str) == sorted(map(tuple, b.collect()), key=str)

    same(D.daily(state, None, cfg), panel.daily_panel(trips, None, cfg))
    same(D.id_counts(state), panel.id_counts(trips))
