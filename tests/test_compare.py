"""Ranking and parity cases worked out by hand."""

import pytest

from panelcast.operators import compare

SCHEMA = "model string, mae double, rmse double, smape double, quantile_loss double, n_points double"


def test_tie_break_on_mae(spark):
    m = spark.createDataFrame(
        [("a", 80.0, 110.0, 1.0, 1.0, 308.0), ("b", 77.0, 101.0, 1.0, 1.0, 308.0), ("c", 70.0, 101.0, 1.0, 1.0, 308.0)], SCHEMA
    )
    r = compare.rank_models(m).orderBy("rank").collect()
    assert [x["model"] for x in r] == ["c", "b", "a"]
    assert r[0]["winner"] and not r[1]["winner"]


def test_nan_sinks_last(spark):
    m = spark.createDataFrame([("bad", 1.0, float("nan"), 1.0, 1.0, 10.0), ("good", 80.0, 110.0, 1.0, 1.0, 10.0)], SCHEMA)
    r = compare.rank_models(m).orderBy("rank").collect()
    assert [x["model"] for x in r] == ["good", "bad"]


def test_missing_metric_is_inf(spark):
    m = spark.createDataFrame([("x", 1.0, 2.0)], "model string, mae double, rmse double")
    r = compare.rank_models(m).first()
    assert r["smape"] == float("inf") and r["n_points"] != r["n_points"]  # NaN


def test_parity_warning(spark):
    m = spark.createDataFrame([("a", 1.0, 1.0, 1.0, 1.0, 308.0), ("b", 1.0, 2.0, 1.0, 1.0, 150.0)], SCHEMA)
    w = compare.parity_warnings(compare.rank_models(m)).collect()
    assert len(w) == 1 and "a=308" in w[0]["warning"] and "b=150" in w[0]["warning"]


@pytest.mark.parametrize("other", [0.0, float("nan")])
def test_parity_ignores_zero_and_missing(spark, other):
    m = spark.createDataFrame([("a", 1.0, 1.0, 1.0, 1.0, 308.0), ("b", 1.0, 2.0, 1.0, 1.0, other)], SCHEMA)
    assert compare.parity_warnings(compare.rank_models(m)).count() == 0
