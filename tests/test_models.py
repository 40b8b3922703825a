"""Regression with AR errors, holiday rules, sweep grid, fingerprint guard."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.config import PanelConfig
from panelcast.operators import sweep
from panelcast.operators.forecast import holidays, xreg
from panelcast.sources.tables import ensure_table, stored_fingerprint


def test_ar1_paths_by_hand():
    e, se = xreg.ar_paths(np.array([0.5]), np.array([0.0] * 6 + [2.0]), 1.0, 3)
    assert e == pytest.approx([1.0, 0.5, 0.25])
    assert se == pytest.approx([1.0, np.sqrt(1 + 0.25), np.sqrt(1 + 0.25 + 0.0625)])
    assert all(a <= b for a, b in zip(se, se[1:]))


def test_select_ar_picks_zero_for_white_noise():
    rng = np.random.default_rng(0)
    r = rng.normal(size=500)
    lags = np.stack([np.roll(r, i) for i in range(1, 8)], axis=1)[7:]
    y = r[7:]
    phi, s2 = xreg.select_ar(lags.T @ lags, lags.T @ y, float(y @ y), len(y), 7)
    assert len(phi) <= 1 and s2 == pytest.approx(1.0, rel=0.2)


def _panel(spark, n=200):
    rng = np.random.default_rng(1)
    rows = []
    start = date(2017, 1, 1)
    for s in ("a", "b"):
        for i in range(n):
            d = start + timedelta(days=i)
            temp = float(10 + 5 * np.sin(i / 9))
            y = int(round(3 + 2 * temp + rng.normal()))
            split = "TEST" if i >= n - 14 else ("VALIDATE" if i >= n - 28 else "TRAIN")
            rows.append((s, d, y, temp, 0.0, (d.isoweekday() % 7) + 1, d.month, int(d.isoweekday() >= 6), split))
    return spark.createDataFrame(
        rows, "series string, date date, target long, temp double, prcp double, day_of_week long, month long, is_weekend long, splits string"
    )


def test_xreg_recovers_slope_and_ignores_test(spark):
    cfg = PanelConfig(horizon=14, holiday_region=None)
    p = _panel(spark)
    train = p.where("splits != 'TEST'")
    infer = p.where("splits = 'TEST'").withColumn("target", F.lit(None).cast("long"))
    model = xreg.fit_xreg(train, cfg, regressors=["temp"])
    beta = model.where("series = 'a'").first()["beta"]
    assert beta[1] == pytest.approx(2.0, abs=0.1)
    fc = xreg.forecast_xreg(model, infer, cfg, regressors=["temp"])
    assert fc.count() == 2 * 14
    rows = fc.orderBy("series", "date").collect()
    assert all(r["q10"] <= r["q30"] <= r["q50"] <= r["q70"] <= r["q90"] for r in rows)
    # refit with TEST targets scrambled: identical predictions (no leakage)
    scrambled = p.withColumn("target", F.when(F.col("splits") == "TEST", F.lit(10**6)).otherwise(F.col("target")))
    model2 = xreg.fit_xreg(scrambled.where("splits != 'TEST'"), cfg, regressors=["temp"])
    rows2 = xreg.forecast_xreg(model2, infer, cfg, regressors=["temp"]).orderBy("series", "date").collect()
    assert [r["forecast"] for r in rows] == pytest.approx([r["forecast"] for r in rows2])


def test_holidays(spark):
    days = ["2018-01-01", "2018-01-15", "2018-02-19", "2018-05-28", "2018-07-04", "2018-09-03", "2018-10-08",
            "2018-11-11", "2018-11-22", "2018-12-25", "2021-06-19", "2018-06-19", "2018-01-08", "2018-11-29"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    got = {str(r["d"]): r["f"] for r in df.select("d", holidays.holiday_flag("d", "US").alias("f")).collect()}
    assert [got[d] for d in days] == [1] * 11 + [0, 0, 0]


def test_holiday_regions(spark):
    """Known days: Easter Sundays of a span of years, moved and kept days."""
    easters = ["1981-04-19", "1954-04-18", "2000-04-23", "2008-03-23", "2011-04-24", "2019-04-21", "2024-03-31", "2038-04-25", "2049-04-18", "2076-04-19"]
    df = spark.createDataFrame([(d,) for d in easters], "d string").select(F.to_date("d").alias("d"))
    assert all(r["d"] == r["e"] for r in df.select("d", holidays.easter_sunday(F.col("d")).alias("e")).collect())
    known = {
        "GB": {"2021-04-02": 1, "2021-04-05": 1, "2021-05-03": 1, "2021-05-31": 1, "2021-08-30": 1, "2021-12-24": 0, "2021-04-04": 0},
        "DE": {"2019-05-30": 1, "2019-06-10": 1, "2019-10-03": 1, "1989-10-03": 0, "2019-04-19": 1},
        "FR": {"2019-07-14": 1, "2019-05-08": 1, "2019-04-22": 1, "2019-04-19": 0},
        "CA": {"2022-05-23": 1, "2020-05-18": 1, "2022-05-30": 0, "2022-09-30": 1, "2020-09-30": 0},
    }
    for region, days in known.items():
        df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
        got = {str(r["d"]): r["f"] for r in df.select("d", holidays.holiday_flag("d", region).alias("f")).collect()}
        assert got == days, region
    kept = {"US": {"2021-07-05": 1, "2020-07-03": 1, "2021-12-24": 1, "2020-07-06": 0}, "GB": {"2021-12-27": 1, "2021-12-28": 1, "2020-12-28": 1, "2020-12-29": 0, "2022-01-03": 1, "2022-12-27": 1}}
    for region, days in kept.items():
        df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
        got = {str(r["d"]): r["f"] for r in df.select("d", holidays.holiday_flag("d", region, observed=True).alias("f")).collect()}
        assert got == days, region
    with pytest.raises(ValueError, match="known are"):
        holidays.holiday_flag("d", "XX")


def test_doe_grid_and_labels(spark):
    cfg = PanelConfig()
    g = sweep.doe_grid(spark, {"forecast.horizon": [7, 14], "data.station_filter.top_n": [10, 25]}, cfg)
    labels = sorted(r["variant"] for r in g.collect())
    assert len(labels) == 4 and "horizon7-top_n10" in labels
    one = sweep.doe_grid(spark, {"forecast.horizon": [14]}, cfg).first()["variant"]
    assert one == "horizon14"
    assert sweep.doe_grid(spark, {}, cfg).first()["variant"] == "base"
    every = sweep.doe_grid(spark, {"data.station_filter.top_n": [None, 5]}, cfg).collect()
    assert {r["variant"]: r["top_n"] for r in every} == {"top_nnone": None, "top_n5": 5}


@pytest.mark.parametrize(
    "axes",
    [{"no.such.path.horizon": [7]}, {"forecast.horizon": [-1]}, {"forecast.horizon": [None]}, {"forecast.horizon": ["7"]},
     {"forecast.horizon": []}, {"data.station_filter.top_n": [0]}, {"forecast.horizon": [True]}],
)
def test_bad_axes_raise(spark, axes):
    with pytest.raises(ValueError):
        sweep.doe_grid(spark, axes, PanelConfig())


def test_fingerprint_guard(spark, tmp_path):
    path = str(tmp_path / "t")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    _, rebuilt = ensure_table(spark, path, "fp1", build)  # missing -> build
    assert rebuilt and stored_fingerprint(spark, path) == "fp1"
    _, rebuilt = ensure_table(spark, path, "fp1", build)  # equal -> skip
    assert not rebuilt
    _, rebuilt = ensure_table(spark, path, "fp2", build)  # stale -> build
    assert rebuilt
    t, rebuilt = ensure_table(spark, path, "fp2", build, force=True)  # forced -> build
    assert rebuilt and len(calls) == 3 and t.count() == 5
    from panelcast.sources.tables import input_identity, read_table, table_properties, write_table

    assert write_table(spark.range(7), path, {"fingerprint": "fp3"}, labels={"a": "b"}, description="seven") == 7  # SC13
    p = table_properties(spark, path)
    assert p == {"fingerprint": "fp3", "rows": 7, "labels": {"a": "b"}, "description": "seven"}
    t = read_table(spark, path)
    assert t.count() == 7
    assert write_table(t.where("id < 3"), path) == 3  # reads the version that it replaces
    assert read_table(spark, path).count() == 3 and t.count() == 7  # readers under way keep theirs
    with pytest.raises(FileNotFoundError):
        read_table(spark, path + "-none")
    other = str(tmp_path / "in")
    spark.range(3).write.parquet(other)
    one = input_identity(spark, other)
    assert one == input_identity(spark, other)
    spark.range(4).write.mode("overwrite").parquet(other)
    assert one and one != input_identity(spark, other)


def test_run_records_and_log(spark, tmp_path):
    cfg = PanelConfig()
    grid = sweep.doe_grid(spark, {"forecast.horizon": [7]}, cfg)
    ranked = spark.createDataFrame(
        [("horizon7", "m1", 1.0, 2.0, 3.0, 4.0, 10.0, 1, True)],
        "variant string, model string, mae double, rmse double, smape double, quantile_loss double, n_points double, rank int, winner boolean",
    )
    rec = sweep.run_records(ranked, grid, "exp")
    r = rec.first()
    assert r["run"] == "exp__horizon7__m1" and r["overrides"] == {"forecast.horizon": "7"} and r["metrics"]["rmse"] == 2.0
    root = str(tmp_path / "log")
    sweep.write_run_log(rec, root)
    sweep.write_run_log(rec.withColumn("rank", F.lit(3)), root)  # the run again: its rows are replaced
    sweep.write_run_log(rec.withColumn("run", F.lit("exp__horizon7__m2")), root)  # another run: a row more
    back = {r["run"]: r["rank"] for r in sweep.read_run_log(spark, root, "exp").collect()}
    assert back == {"exp__horizon7__m1": 3, "exp__horizon7__m2": 1}
    assert sweep.read_run_log(spark, root, "other").count() == 0
    # a run whose rows were written without their commit is not read
    torn = rec.withColumn("run", F.lit("exp__torn"))
    torn.write.mode("append").partitionBy("experiment", "run").parquet(f"{root}/records")
    rec.write.mode("append").partitionBy("experiment", "run").parquet(f"{root}/records")  # rows past the commit
    assert [r["run"] for r in sweep.read_run_log(spark, root).collect()] == ["exp__horizon7__m2"]


def test_sweep_test_length_axis(spark):
    from panelcast.operators import panel as P
    from panelcast.sources import adapters

    trips, w, m, cfg = adapters.adapter_inputs(spark, "/root/testdata/sf0.001", "nation")
    prepped = P.build_tables(trips, w, m, cfg)
    grid = sweep.doe_grid(spark, {"data.splits.test_length": [7, 14]}, cfg)
    sp, variants = sweep.sweep_panel(trips, prepped, grid, cfg)
    acts = sweep.sweep_actuals(sp, variants)
    days = {r["variant"]: r["n"] for r in acts.groupBy("variant").agg(F.countDistinct("date").alias("n")).collect()}
    assert days == {"test_length7": 7, "test_length14": 14}
    preds = sweep.sweep_naive(sp, variants, {"seasonal_naive": 7})
    ranked = {r["variant"]: r for r in sweep.sweep_scores(preds, acts).collect()}
    assert set(ranked) == {"test_length7", "test_length14"}
    assert ranked["test_length7"]["n_points"] < ranked["test_length14"]["n_points"]
    assert all(r["winner"] for r in ranked.values())


def test_sweep_needs_the_largest_top_n(spark):
    from panelcast.operators import panel as P
    from panelcast.sources import adapters

    trips, w, m, cfg = adapters.adapter_inputs(spark, "/root/testdata/sf0.001", "nation")
    small = P.build_tables(trips, w, m, cfg.replace(top_n=5))
    grid = sweep.doe_grid(spark, {"data.station_filter.top_n": [5, 10]}, cfg)
    with pytest.raises(ValueError, match="lacks series"):
        sweep.sweep_panel(trips, small, grid, cfg)


def test_caller_predictor_runs_in_workers(spark):
    from panelcast.operators.forecast import zero_shot

    def factory():
        def predict(inputs, horizon):
            point = np.array([[10.0 * len(x) + h for h in range(1, horizon + 1)] for x in inputs])
            return point, np.repeat(point[:, :, None], 10, axis=2) + np.arange(10)

        return predict

    ctx = spark.createDataFrame([("a", [1.0, 2.0], 2), ("b", [5.0], 1)], "series string, context array<double>, n int")
    ctx = ctx.withColumn("last_date", F.to_date(F.lit("2020-01-01")))
    out = zero_shot.zero_shot_forecast(ctx, PanelConfig(horizon=2), factory, model="mine").orderBy("series", "date").collect()
    assert [(r["series"], r["forecast"], r["q10"], r["q90"], r["model"]) for r in out] == [
        ("a", 21.0, 22.0, 30.0, "mine"), ("a", 22.0, 23.0, 31.0, "mine"), ("b", 11.0, 12.0, 20.0, "mine"), ("b", 12.0, 13.0, 21.0, "mine"),
    ]


def test_ar_order_with_few_rows():
    rng = np.random.default_rng(1)
    e = rng.normal(size=9)
    r = np.array([0.9**i for i in range(9)]) * 5 + 0.01 * e
    lag = np.stack([np.r_[np.zeros(i), r[:-i]] for i in range(1, 8)], axis=1)[1:]
    y = r[1:]
    phi, _ = xreg.select_ar(lag.T @ lag, lag.T @ y, float(y @ y), len(y), 7)
    assert len(phi) >= 1  # eight rows are too few for seven lags, not for one


def test_grouped_quantiles_are_exact(spark):
    from panelcast.operators.quantiles import grouped_quantiles

    rng = np.random.default_rng(2)
    data = {
        1.0: rng.normal(size=401), 2.0: np.r_[np.zeros(50), 7.0], 3.0: np.array([4.0]), 4.0: rng.integers(0, 3, 200).astype(float),
        5.0: np.r_[rng.normal(size=999), 1e12], 6.0: np.r_[np.full(400, 2.5), rng.normal(size=600)],
    }
    df = spark.createDataFrame([(h, float(v)) for h, vs in data.items() for v in vs] + [(1.0, None)], "h double, r double")
    levels = [0.0, 0.1, 0.3, 0.5, 0.7, 0.9, 1.0]
    for ranges in (1, 7, 512):
        got = {r["h"]: r["quantiles"] for r in grouped_quantiles(df.repartition(5), ["h"], "r", levels, ranges).collect()}
        for h, vs in data.items():
            assert got[h] == pytest.approx(np.quantile(vs, levels)), (ranges, h)


def test_quantile_ranges_stay_even_under_heavy_tails(spark):
    from panelcast.operators import quantiles as Q

    rng = np.random.default_rng(4)
    for values in (np.r_[rng.normal(size=20_000), 1e9], rng.standard_cauchy(20_001), np.exp(8 * rng.normal(size=20_001))):
        df = spark.createDataFrame(pd.DataFrame({"h": 1, "r": values}))
        sizes = {r["bin"]: r["n"] for r in Q.placed(df, ["h"], "r").groupBy("bin").agg(F.count("*").alias("n")).collect()}
        assert sum(sizes.values()) == 20_001 and max(sizes.values()) < 201
        got = Q.grouped_quantiles(df, ["h"], "r", [0.1, 0.5, 0.9]).first()["quantiles"]
        assert got == pytest.approx(np.quantile(values, [0.1, 0.5, 0.9]))


def test_global_model_from_its_reference(spark, tmp_path):
    from panelcast.operators import panel as P
    from panelcast.operators.forecast import global_gbt
    from panelcast.sources import adapters

    trips, w, m, cfg = adapters.adapter_inputs(spark, "/root/testdata/sf0.001", "nation")
    cfg = cfg.replace(top_n=4, horizon=3, test_length=3, validate_length=14)
    prepped = P.build_tables(trips, w, m, cfg).cache()
    path = str(tmp_path / "model")
    global_gbt.fit_global(prepped, cfg, path, max_iter=2, max_depth=2)
    fc = global_gbt.forecast_global(global_gbt.GlobalModel.load(spark, path), prepped, cfg).orderBy("series", "date").collect()
    series = sorted({r["series"] for r in fc})
    assert len(fc) == len(series) * 3 and len(series) == 4
    for s in series:
        days = [r["date"] for r in fc if r["series"] == s]
        assert [(d - days[0]).days for d in days] == [0, 1, 2]
    assert all(r["q10"] <= r["q30"] <= r["q50"] <= r["q70"] <= r["q90"] for r in fc)
    scrambled = prepped.withColumn("target", F.when(F.col("splits") == "TEST", F.lit(10**6).cast("long")).otherwise(F.col("target")))
    global_gbt.fit_global(scrambled, cfg, path + "2", max_iter=2, max_depth=2)
    again = global_gbt.forecast_global(global_gbt.GlobalModel.load(spark, path + "2"), scrambled, cfg).orderBy("series", "date").collect()
    assert [r["forecast"] for r in fc] == pytest.approx([r["forecast"] for r in again])


def test_xreg_interval_and_reference(spark, tmp_path):
    from panelcast.operators import panel as P
    from panelcast.sources import adapters

    trips, w, m, cfg = adapters.adapter_inputs(spark, "/root/testdata/sf0.001", "nation")
    cfg = cfg.replace(top_n=3)
    prepped = P.build_tables(trips, w, m, cfg)
    path = str(tmp_path / "xreg")
    xreg.fit_xreg(P.build_train(prepped), cfg, model_path=path)
    raw = xreg.forecast_xreg_raw(xreg.load_xreg(spark, path), P.build_infer(prepped, cfg), cfg, confidence=0.95).collect()
    assert len(raw) == 3 * cfg.horizon
    for r in raw:
        half = 1.959964 * r["standard_error"]
        assert r["prediction_interval_upper_bound"] - r["forecast_value"] == pytest.approx(half, rel=1e-5)
        assert r["forecast_value"] - r["prediction_interval_lower_bound"] == pytest.approx(half, rel=1e-5)
    with pytest.raises(ValueError):
        xreg.forecast_xreg_raw(xreg.load_xreg(spark, path), P.build_infer(prepped, cfg), cfg, confidence=1.0)


def test_shared_folder_must_be_named_off_local():
    from types import SimpleNamespace

    from panelcast.session import ensure_checkpoint_dir

    nothing = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(master="yarn", getConf=lambda: nothing)
    with pytest.raises(RuntimeError, match="executors share"):
        ensure_checkpoint_dir(SimpleNamespace(conf=nothing, sparkContext=sc))


def test_fitted_sweep_equals_one_fit_per_variant(spark):
    from panelcast.operators import panel as P
    from panelcast.operators import sweep_fit
    from panelcast.sources import adapters

    trips, w, m, cfg = adapters.adapter_inputs(spark, "/root/testdata/sf0.001", "nation")
    cfg = cfg.replace(top_n=6)
    source = P.build_source(trips, w, m, cfg).cache()
    axes = {"data.splits.test_length": [5, 14], "forecast.horizon": [3, 9], "data.station_filter.top_n": [3, 6]}
    grid = sweep.doe_grid(spark, axes, cfg)
    # a covariate with holes, so that the means move with the cut
    prepped = P.build_prepped(source, cfg).withColumn("temp", F.when(F.pmod(F.dayofyear("date"), F.lit(3)) > 0, F.col("temp"))).cache()
    rows, variants = sweep.sweep_panel(trips, prepped, grid, cfg)
    ranks = rows.groupBy("series").agg(F.max("volume_rank").alias("volume_rank"))
    got = sweep_fit.sweep_xreg(prepped, ranks, variants, cfg).toPandas()
    assert got["variant"].nunique() == 8
    for v in variants:
        own = prepped.join(ranks.where(F.col("volume_rank") <= v["top_n"]), "series", "left_semi").drop("splits")
        own = P.build_prepped(own, cfg.replace(test_length=v["test_length"]))
        one = cfg.replace(horizon=v["horizon"])
        want = xreg.forecast_xreg(xreg.fit_xreg(P.build_train(own), one), P.build_infer(own, one), one).toPandas()
        mine = got[got["variant"] == v["variant"]].merge(want, on=["series", "date"], suffixes=("", "_w"))
        assert len(mine) == len(want) == (got["variant"] == v["variant"]).sum() > 0
        for c in ("forecast", "q10", "q90", "horizon_step"):
            assert mine[c].to_numpy() == pytest.approx(mine[f"{c}_w"].to_numpy(), rel=1e-6, abs=1e-6), (v["variant"], c)


def test_sweep_of_all_series_beside_a_number(spark):
    from panelcast.operators import panel as P
    from panelcast.sources import adapters

    trips, w, m, cfg = adapters.adapter_inputs(spark, "/root/testdata/sf0.001", "nation")
    cfg = cfg.replace(top_n=None)
    prepped = P.build_tables(trips, w, m, cfg)
    grid = sweep.doe_grid(spark, {"data.station_filter.top_n": [3, None]}, cfg)
    sp, variants = sweep.sweep_panel(trips, prepped, grid, cfg)
    acts = sweep.sweep_actuals(sp, variants)
    n = {r["variant"]: r["n"] for r in acts.groupBy("variant").agg(F.countDistinct("series").alias("n")).collect()}
    names = [r["variant"] for r in grid.orderBy(F.col("top_n").isNull()).collect()]
    total = prepped.where("splits = 'TEST'").select("series").distinct().count()
    assert n[names[1]] == total and 0 < n[names[0]] <= 3
