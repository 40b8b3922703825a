"""Differences and ARMA errors against numpy over whole series, and on series that need them."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.config import PanelConfig, Roles
from panelcast.operators.forecast import arima as A
from panelcast.operators.forecast import xreg

CFG = PanelConfig(holiday_region=None, roles=Roles(attribute=(), available=(), unavailable=()))
N, H = 300, 14


def make(kind, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=N + H + 50)
    t = np.arange(N + H)
    noise = e[50:]
    week = np.array([5.0, 1, 0, -2, -4, -3, 8])
    return {
        "white": 20 + noise,
        "trend": 50 + np.cumsum(0.5 + 0.3 * noise),
        "weekly": 40 + 3 * week[t % 7] + np.cumsum(0.05 * e[50:]) + noise,
        "both": 100 + 0.8 * t + 3 * week[t % 7] + noise,
        "ma": 30 + noise + 0.8 * e[49:-1],
        "constant": np.full(N + H, 7.0),
        "short": 10 + noise,
    }[kind]


KINDS = ("white", "trend", "weekly", "both", "ma", "constant", "short")
START = datetime.date(2020, 1, 1)


@pytest.fixture(scope="module")
def data():
    return {k: make(k, i) for i, k in enumerate(KINDS)}


@pytest.fixture(scope="module")
def fitted(spark, data):
    rows = []
    for k, y in data.items():
        n = 12 if k == "short" else N
        rows += [(k, START + datetime.timedelta(days=i), float(y[i]), "TRAIN") for i in range(N - n, N)]
    train = spark.createDataFrame(rows, "series string, date date, target double, splits string").repartition(5)
    future = spark.createDataFrame([], "series string, date date, target double, splits string")
    return train, future, A.fit_arima(train, CFG)


def brute(y):
    """Parameters by loops over the whole series."""
    r = y - y.mean()
    n = len(r)
    s = np.cumsum(r)
    width = min(int(4 * (n / 100) ** 0.25), A.MAX_BANDWIDTH)
    lrv = (r @ r + sum(2 * (1 - k / (width + 1)) * (r[k:] @ r[:-k]) for k in range(1, width + 1))) / n
    kpss = (s @ s) / n**2 / lrv if lrv > 1e-9 else 0.0
    d = int(kpss > A.KPSS_5)
    dates = np.array([(START + datetime.timedelta(days=N - n + i)).weekday() for i in range(n)])
    x = np.diff(r) if d else r
    days = dates[1:] if d else dates
    total = ((x - x.mean()) ** 2).sum()
    share = sum((days == k).sum() * (x[days == k].mean() - x.mean()) ** 2 for k in range(7)) / total if total > 1e-9 else 0.0
    seasonal = int(share > A.SEASONAL and n >= 42)
    w = x[7:] - x[:-7] if seasonal else x
    rows = range(A.LONG, len(w))
    X = np.array([[1, *(w[t - k] for k in range(1, A.LONG + 1))] for t in rows])
    e = np.full(len(w), np.nan)
    if len(X) >= 3 * (A.LONG + 1):
        a = np.linalg.lstsq(X, w[A.LONG :], rcond=None)[0]
        e[A.LONG :] = w[A.LONG :] - X @ a
    else:
        e[A.LONG :] = w[A.LONG :]
    best = None
    rows = [t for t in range(A.WEEK, len(w)) if t - A.WEEK >= 0 and not np.isnan(e[t - A.WEEK])]
    Z = np.array([[1, *(w[t - k] for k in A.AR_LAGS), *(e[t - k] for k in A.MA_LAGS)] for t in rows]).reshape(len(rows), -1)
    target = w[rows]
    for order in A.orders():
        if len(rows) < len(order) + 2:
            continue
        c = np.linalg.lstsq(Z[:, order], target, rcond=None)[0]
        sse = ((target - Z[:, order] @ c) ** 2).sum()
        if sse <= 1e-12:
            continue
        aic = len(rows) * np.log(sse / len(rows)) + 2 * len(order)
        const, ar, ma = A.dense(order, c)
        if (best is None or aic < best[0] - 1e-9) and A.steady(ar) and A.steady(-ma):
            best = (aic, const, ar, ma, np.sqrt(sse / len(rows)))
    return kpss, d, share, seasonal, best


def test_parameters_match_numpy(data, fitted):
    model = {r["series"]: r for r in fitted[2].collect()}
    assert set(model) == set(KINDS)
    for k in ("white", "trend", "weekly", "both", "ma"):
        kpss, d, share, seasonal, (_, const, ar, ma, sigma) = brute(data[k][:N])
        m = model[k]
        assert (m["d"], m["seasonal"]) == (d, seasonal), k
        assert [m["kpss"], m["strength"]] == pytest.approx([kpss, share], rel=1e-6)
        assert m["ar"] == pytest.approx(ar, rel=1e-4, abs=1e-5) and m["ma"] == pytest.approx(ma, rel=1e-4, abs=1e-5), k
        assert [m["const"], m["sigma"]] == pytest.approx([const, sigma], rel=1e-4, abs=1e-5)
    assert (model["trend"]["d"], model["weekly"]["seasonal"], model["white"]["d"], model["white"]["seasonal"]) == (1, 1, 0, 0)
    assert any(model["ma"]["ma"])
    for k in ("constant", "short"):  # too little to fit: finite, and no autoregression out of nothing
        assert np.isfinite(model[k]["sigma"]) and np.isfinite(model[k]["ar"]).all()


def test_differences_and_weeks_beat_ar_on_the_held_out_days(spark, data, fitted):
    train, future, model = fitted
    ours = A.forecast_arima(model, future, CFG, regressors=[]).toPandas()
    plain = xreg.forecast_xreg(xreg.fit_xreg(train, CFG, regressors=[]), future, CFG, regressors=[]).toPandas()
    assert len(ours) == len(plain) == len(KINDS) * H

    def rmse(frame, k):
        got = frame[frame.series == k].sort_values("date")
        return float(np.sqrt(((got["forecast"].to_numpy() - data[k][N:]) ** 2).mean()))

    for k in ("trend", "weekly", "both"):
        assert rmse(ours, k) < rmse(plain, k), (k, rmse(ours, k), rmse(plain, k))
    assert rmse(ours, "constant") < 1e-6
    q = ours[["q10", "q30", "q50", "q70", "q90"]].to_numpy()
    assert np.isfinite(q).all() and (np.diff(q, axis=1) >= -1e-12).all()


def test_path_by_hand():
    ar, ma = np.zeros(7), np.zeros(7)
    ar[0], ma[0] = 0.5, 0.4
    out, se = A.arima_path(0, 0, 1.0, ar, ma, 2.0, 0.0, [0.0] * 7, [4.0, *[0.0] * 6], [1.0, *[0.0] * 6], 3)
    assert out == pytest.approx([1 + 2 + 0.4, 1 + 1.7, 1 + 1.35])
    psi = [1.0, 0.9, 0.45]
    assert se == pytest.approx([2 * np.sqrt(sum(p * p for p in psi[: k + 1])) for k in range(3)])
    # a random walk with weekly differences: x repeats last week's steps, the level adds them up
    out, se = A.arima_path(1, 1, 0.0, np.zeros(7), np.zeros(7), 1.0, 10.0, [7, 6, 5, 4, 3, 2, 1], [0.0] * 7, [0.0] * 7, 8)
    assert out == pytest.approx([11, 13, 16, 20, 25, 31, 38, 39])
    assert se[-1] == pytest.approx(np.sqrt(7 + 4))


def test_empty_panel(spark):
    none = spark.createDataFrame([], "series string, date date, target double, splits string")
    assert A.fit_arima(none, CFG).count() == 0


def test_stationarity_of_a_gap_free_panel_is_per_series(spark):
    pdf = pd.DataFrame({"series": ["a"] * 50 + ["b"] * 50, "date": [START + datetime.timedelta(days=i % 50) for i in range(100)]})
    pdf["r"] = np.r_[np.arange(50.0) - 24.5, np.random.default_rng(8).normal(size=50)]
    got = {r["series"]: r for r in A.stationarity(spark.createDataFrame(pdf).withColumn("date", F.col("date").cast("date"))).collect()}
    assert got["a"]["d"] == 1 and got["b"]["d"] == 0
