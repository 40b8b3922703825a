"""Scorer cases computed by hand."""

import math
from datetime import date

import pytest

from panelcast.operators import score


def preds_df(spark, rows):
    cols = "series string, date date, horizon_step int, forecast double, q10 double, q30 double, q50 double, q70 double, q90 double, model string"
    full = [(s, d, i + 1, f, f, f, f, f, f, "m") for i, (s, d, f) in enumerate(rows)]
    return spark.createDataFrame(full, cols)


def acts_df(spark, rows):
    return spark.createDataFrame(rows, "series string, date date, actual double")


D1, D2 = date(2018, 5, 18), date(2018, 5, 19)


def test_mae_rmse(spark):
    p = preds_df(spark, [("s", D1, 10.0), ("s", D2, 12.0)])
    a = acts_df(spark, [("s", D1, 12.0), ("s", D2, 12.0)])
    r = score.evaluate(p, a).first()
    assert r["mae"] == pytest.approx(1.0)
    assert r["rmse"] == pytest.approx(math.sqrt(2))
    assert r["n_points"] == 2


def test_partial_overlap_counts(spark):
    p = preds_df(spark, [("s", D1, 10.0), ("s", D2, 12.0)])
    a = acts_df(spark, [("s", D2, 12.0)])
    r = score.evaluate(p, a).first()
    assert r["n_points"] == 1 and r["mae"] == pytest.approx(0.0)
    o = score.overlap_counts(p, a).first()
    assert (o["predictions_unmatched"], o["actuals_unmatched"], o["n_matched"]) == (1, 0, 1)


def test_empty_overlap_raises(spark):
    p = preds_df(spark, [("s", D1, 10.0)])
    a = acts_df(spark, [("s", date(2019, 1, 1), 12.0)])
    with pytest.raises(ValueError):
        score.require_overlap(score.evaluate(p, a), p)


def test_smape(spark):
    p = preds_df(spark, [("s", D1, 10.0), ("s", D2, 12.0)])
    a = acts_df(spark, [("s", D1, 12.0), ("s", D2, 12.0)])
    r = score.evaluate(p, a).first()
    assert r["smape"] == pytest.approx(((2 / 11) + 0) / 2 * 100)


def test_smape_both_zero(spark):
    p = preds_df(spark, [("s", D1, 0.0)])
    a = acts_df(spark, [("s", D1, 0.0)])
    assert score.evaluate(p, a).first()["smape"] == pytest.approx(0.0)


def test_pinball(spark):
    cols = "series string, date date, horizon_step int, forecast double, q10 double, q30 double, q50 double, q70 double, q90 double, model string"
    p = spark.createDataFrame([("s", D1, 1, 10.0, 8.0, 9.0, 10.0, 11.0, 13.0, "m")], cols)
    a = acts_df(spark, [("s", D1, 10.0)])
    levels = [(0.1, 8), (0.3, 9), (0.5, 10), (0.7, 11), (0.9, 13)]
    expected = sum(max(q * (10 - v), (q - 1) * (10 - v)) for q, v in levels) / 5
    assert score.evaluate(p, a).first()["quantile_loss"] == pytest.approx(expected)


def test_per_series(spark):
    p = preds_df(spark, [("a", D1, 10.0), ("a", D2, 10.0), ("b", D1, 20.0)])
    a = acts_df(spark, [("a", D1, 12.0), ("a", D2, 8.0), ("b", D1, 20.0)])
    rows = {r["series"]: r for r in score.evaluate_per_series(p, a).collect()}
    assert rows["a"]["mae"] == pytest.approx(2.0) and rows["a"]["n_points"] == 2
    assert rows["b"]["mae"] == pytest.approx(0.0) and rows["b"]["n_points"] == 1


def test_nan_forecast_poisons_mean(spark):
    p = preds_df(spark, [("s", D1, float("nan")), ("s", D2, 12.0)])
    a = acts_df(spark, [("s", D1, 12.0), ("s", D2, 12.0)])
    assert math.isnan(score.evaluate(p, a).first()["mae"])


def test_grouping_sets_match_separate(spark):
    p = preds_df(spark, [("a", D1, 10.0), ("a", D2, 10.0), ("b", D1, 20.0)])
    a = acts_df(spark, [("a", D1, 12.0), ("a", D2, 8.0), ("b", D1, 19.0)])
    both = score.evaluate_both(p, a).collect()
    overall = [r for r in both if r["level"] == "overall"][0]
    assert overall["mae"] == pytest.approx(score.evaluate(p, a).first()["mae"])
    assert len([r for r in both if r["level"] == "series"]) == 2


def test_overlap_counts_with_repeated_keys_and_variants(spark):
    p = spark.createDataFrame([("m", "v1", "a", "2020-01-01"), ("m", "v2", "a", "2020-01-01")], "model string, variant string, series string, date string")
    p = p.withColumn("date", p["date"].cast("date"))
    a = spark.createDataFrame([("a", "2020-01-01"), ("a", "2020-01-01"), ("b", "2020-01-02")], "series string, date string")
    o = score.overlap_counts(p.where("variant = 'v1'"), a).first()
    assert (o["n_predictions"], o["n_matched"], o["predictions_unmatched"], o["actuals_unmatched"]) == (1, 1, 0, 1)
    by = spark.createDataFrame([("v1", "a", "2020-01-01"), ("v2", "a", "2020-01-01"), ("v2", "b", "2020-01-02")], "variant string, series string, date string")
    rows = {r["variant"]: r for r in score.overlap_counts(p, by, ("variant", "model")).collect()}
    assert rows["v1"]["actuals_unmatched"] == 0 and rows["v2"]["actuals_unmatched"] == 1


def test_lost_model_is_named(spark):
    cols = "model string, series string, date date, forecast double, q10 double, q30 double, q50 double, q70 double, q90 double"
    import datetime

    d, far = datetime.date(2020, 1, 1), datetime.date(2030, 1, 1)
    p = spark.createDataFrame([("good", "a", d, *[1.0] * 6), ("lost", "a", far, *[1.0] * 6)], cols)
    a = spark.createDataFrame([("a", d, 2.0)], "series string, date date, actual double")
    with pytest.raises(ValueError, match="lost"):
        score.require_overlap(score.evaluate(p, a), p)
    good = p.where("model = 'good'")
    assert score.require_overlap(score.evaluate(good, a), good).count() == 1
