"""Context building, channel mapping, array <-> long shapes, struct flatten."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from panelcast.config import PanelConfig
from panelcast.operators import contexts, frames, panel
from panelcast.operators.forecast import zero_shot


def history(spark, n_days=600, test=14, val=14):
    start = date(2016, 1, 1)
    rows = []
    for s in range(2):
        for i in range(n_days):
            split = "TEST" if i >= n_days - test else ("VALIDATE" if i >= n_days - test - val else "TRAIN")
            rows.append((f"s{s}", start + timedelta(days=i), i + s, split))
    return spark.createDataFrame(rows, "series string, date date, target long, splits string")


def test_context_truncation_and_first_date(spark):
    cfg = PanelConfig(context_len=512, horizon=14)
    ctx = contexts.series_contexts(history(spark), cfg)
    r = {x["series"]: x for x in ctx.collect()}
    assert len(r["s0"]["context"]) == 512
    assert r["s0"]["context"][-1] == 585.0 and r["s1"]["context"][-1] == 586.0
    fc = zero_shot.seasonal_naive(ctx, 14, 7, "m")
    first = fc.where("series = 's0' AND horizon_step = 1").first()
    assert first["date"] == r["s0"]["last_date"] + timedelta(days=1)
    assert fc.count() == 2 * 14


def test_step_contexts_last_non_test(spark):
    cfg = PanelConfig(context_len=32)
    ctx = contexts.series_contexts(history(spark, 80, test=3, val=0), cfg)
    r = ctx.where("series = 's0'").first()
    assert r["last_date"] == date(2016, 1, 1) + timedelta(days=76) and len(r["context"]) == 32


def test_channels_ten_and_five(spark):
    raw = spark.createDataFrame(
        [("a", date(2018, 3, 1), 1, [0.0], [[float(c) for c in range(10)]]), ("b", date(2018, 3, 1), 1, [0.0], [[float(c) for c in range(5)]])],
        "series_id string, last_date date, horizon int, forecast array<double>, channels array<array<double>>",
    )
    r = {x["series_id"]: x for x in zero_shot.pick_quantiles(raw).collect()}
    assert [r["a"][q][0] for q in ("q10", "q30", "q50", "q70", "q90")] == [1, 3, 5, 7, 9]
    assert [r["b"][q][0] for q in ("q10", "q30", "q50", "q70", "q90")] == [0, 1, 2, 3, 4]
    wide = spark.createDataFrame([("c", date(2018, 3, 1), 1, [0.0], [[float(c) for c in range(21)]])], raw.schema)
    assert [zero_shot.pick_quantiles(wide).first()[q][0] for q in ("q10", "q50", "q90")] == [1, 5, 9]  # a larger head starts with the deciles


def test_response_to_rows(spark):
    resp = spark.createDataFrame(
        [("s", 3, [1.0, 2.0, 3.0], [1.0] * 3, [1.0] * 3, [1.0] * 3, [1.0] * 3, [1.5, 2.5, 3.5])],
        "series_id string, horizon int, forecast array<double>, q10 array<double>, q30 array<double>, q50 array<double>, q70 array<double>, q90 array<double>",
    )
    last = spark.createDataFrame([("s", date(2018, 3, 1))], "series string, last_date date")
    rows = contexts.responses_to_frame(resp, last, "m").orderBy("horizon_step").collect()
    assert len(rows) == 3 and rows[0]["date"] == date(2018, 3, 2) and rows[2]["q90"] == 3.5


def test_serving_context_limit(spark):
    req = spark.createDataFrame([("s", [float(i) for i in range(600)])], "series_id string, context array<double>")
    r = contexts.truncate_context(req, 128).first()["context"]
    assert len(r) == 128 and r[-1] == 599.0 and r[0] == 472.0


def test_gaussian_quantiles(spark):
    raw = spark.createDataFrame([("s", "2018-03-02", 10.0, 2.0)], "series string, forecast_timestamp string, forecast_value double, standard_error double")
    r = frames.from_point_stderr(raw.withColumn("forecast_timestamp", F.to_timestamp("forecast_timestamp")), "series", "m").first()
    assert r["q50"] == pytest.approx(10.0) and r["q90"] == pytest.approx(10 + 1.2815515594 * 2)
    assert r["horizon_step"] == 1


def _nested(spark, levels, preds):
    return spark.createDataFrame(
        [("s", date(2018, 3, 2), (10.0, levels, preds))],
        "series string, date date, predicted_target struct<value:double, quantile_values:array<double>, quantile_predictions:array<double>>",
    )


def test_struct_flatten_by_level(spark):
    df = _nested(spark, [0.5, 0.1, 0.9, 0.3, 0.7], [10.0, 8.0, 12.0, 9.0, 11.0])
    r = frames.flatten_nested(df, "target", "series", "date", "m").first()
    assert (r["q10"], r["q50"], r["q90"]) == (8.0, 10.0, 12.0)


def test_struct_flatten_missing_level_raises(spark):
    df = _nested(spark, [0.5, 0.1, 0.3, 0.7], [10.0, 8.0, 9.0, 11.0])
    with pytest.raises(Exception):
        frames.flatten_nested(df, "target", "series", "date", "m").collect()


def test_quantile_crossing_fix(spark):
    cols = "series string, date date, horizon_step int, forecast double, q10 double, q30 double, q50 double, q70 double, q90 double, model string"
    df = spark.createDataFrame([("s", date(2018, 1, 1), 1, 5.0, 9.0, 3.0, 5.0, 1.0, 7.0, "m")], cols)
    r = zero_shot.fix_quantile_crossing(df).first()
    assert [r[q] for q in ("q10", "q30", "q50", "q70", "q90")] == [1.0, 3.0, 5.0, 7.0, 9.0]


def test_batched_slot_equals_expressions(spark):
    cfg = PanelConfig(context_len=64, horizon=10)
    ctx = contexts.series_contexts(history(spark, 120), cfg)
    a = zero_shot.seasonal_naive(ctx, 10, 7, "m").orderBy("series", "date").collect()
    b = zero_shot.zero_shot_forecast(ctx, cfg, "seasonal_naive", "m").orderBy("series", "date").collect()
    for x, y in zip(a, b):
        for c in ("forecast", "q10", "q50", "q90"):
            assert x[c] == pytest.approx(y[c])


def test_no_test_leakage_zero_shot(spark):
    cfg = PanelConfig(context_len=64, horizon=14)
    h = history(spark, 120)
    scrambled = h.withColumn("target", F.when(F.col("splits") == "TEST", F.lit(99999)).otherwise(F.col("target")))
    a = zero_shot.seasonal_naive(contexts.series_contexts(h, cfg), 14).orderBy("series", "date").collect()
    b = zero_shot.seasonal_naive(contexts.series_contexts(scrambled, cfg), 14).orderBy("series", "date").collect()
    assert a == b


def test_unused_panel_import_is_available():
    assert callable(panel.build_source)
