"""Model fits checked against brute force (numpy / pandas) on the small tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import panel as P
from panelcast.operators.forecast import global_gbt, xreg
from panelcast.sources import adapters

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def nation(spark):
    trips, w, m, cfg = adapters.adapter_inputs(spark, SF_SMALL, "nation")
    cfg = cfg.replace(holiday_region=None)
    return P.build_tables(trips, w, m, cfg).cache(), cfg


def test_xreg_beta_and_ar_match_numpy(spark, nation):
    prepped, cfg = nation
    regs = ["temp", "day_of_week"]
    train = P.build_train(prepped)
    model = {r["series"]: r for r in xreg.fit_xreg(train, cfg, regressors=regs, ridge=0.0).collect()}
    pdf = train.select("series", "date", F.col("target").cast("double").alias("y"), *regs).toPandas()
    checked = 0
    for s, g in pdf.groupby("series"):
        g = g.sort_values("date")
        x = g[regs].astype(float)
        x = x.fillna(x.mean()).fillna(0.0)
        X = np.column_stack([np.ones(len(g)), x.to_numpy(), np.zeros(len(g))])  # holiday column is 0 (no region)
        if len(g) < X.shape[1]:
            continue
        beta = np.linalg.lstsq(X[:, :-1], g["y"].to_numpy(), rcond=None)[0]
        got = np.asarray(model[s]["beta"])[:-1]
        assert got == pytest.approx(beta, rel=1e-4, abs=1e-6)
        # AR part: OLS of residuals on their own lags for the chosen order
        r = g["y"].to_numpy() - X @ np.r_[got, model[s]["beta"][-1]]
        p = len(model[s]["phi"])
        if p:
            lags = np.column_stack([r[7 - i: len(r) - i] for i in range(1, p + 1)])
            phi = np.linalg.lstsq(lags, r[7:], rcond=None)[0]
            assert np.asarray(model[s]["phi"]) == pytest.approx(phi, rel=1e-3, abs=1e-6)
        assert list(model[s]["last_resid"])[-1] == pytest.approx(r[-1], abs=1e-6)
        checked += 1
    assert checked >= 5


@pytest.fixture(scope="module")
def binned(spark, nation):
    """(binned day rows, their expansion by pandas: label, bins by name and step) of a small panel."""
    prepped, cfg = nation
    cfg = cfg.replace(horizon=4)
    days = global_gbt.day_rows(prepped, cfg).cache()
    edges = global_gbt.bin_edges(days, cfg, 16)
    pdf = days.toPandas().sort_values(["series", "date"])
    names = global_gbt.feature_names(cfg)[1:]
    codes = {c: [0 if pd.isna(v) else 1 + sum(e < v for e in edges[c]) for v in pdf[c].astype(float)] for c in names}
    base = pdf[["series", "date", "splits", "label"]].assign(**codes)
    rows = []
    for h in range(1, 5):
        shifted = base.copy()
        for c in global_gbt.origin_features(cfg):
            shifted[c] = base.groupby("series")[c].shift(h)
        rows.append(shifted.assign(h=h).dropna(subset=["y_mean"]))
    return global_gbt.binned(days, cfg, edges).cache(), pd.concat(rows), cfg


def test_gbt_rows_match_pandas_shift(spark, binned):
    rows, want, cfg = binned
    got = rows.toPandas()
    x, day = global_gbt.expand(list(got["known"]), list(got["origins"]), cfg.horizon)
    names = global_gbt.feature_names(cfg)
    found = pd.DataFrame(x, columns=names).assign(series=got["series"].to_numpy()[day], date=got["date"].to_numpy()[day])
    both = found.merge(want, on=["series", "date", "h"], suffixes=("", "_w"))
    assert len(both) == len(found) == len(want) > 500
    for c in names[1:]:
        assert (both[c] == both[f"{c}_w"]).all(), c


def brute_boost(x, y, rounds, depth, rate, min_rows, levels):
    """Boosting by plain loops over rows: predictions of each level."""
    cut = lambda v, q: sorted(v)[max(int(np.ceil(q * len(v) - 1e-9)) - 1, 0)]
    out = []
    for q in levels:
        f = np.full(len(y), cut(y, q))
        for _ in range(rounds):
            nodes = [np.arange(len(y))]
            for _ in range(depth):
                split = []
                for at in nodes:
                    g = np.where(y[at] < f[at], q - 1, q)
                    best, choice = 1e-9, None
                    for j in range(x.shape[1]):
                        for limit in range(int(x[:, j].max(initial=0)) + 1):
                            left = x[at, j] <= limit
                            n, m = left.sum(), (~left).sum()
                            if n < min_rows or m < min_rows:
                                continue
                            gain = round(g[left].sum() ** 2 / n + g[~left].sum() ** 2 / m - g.sum() ** 2 / len(at), 9)
                            if gain > best:
                                best, choice = gain, left
                    split += [at, at[:0]] if choice is None else [at[choice], at[~choice]]
                nodes = split
            step = np.zeros(len(y))
            for at in nodes:
                if len(at):
                    step[at] = rate * cut(y[at] - f[at], q)
            f = f + step
        out.append(f)
    return np.stack(out, axis=1)


@pytest.mark.parametrize("rounds, depth", [(1, 1), (2, 2)])
def test_boosting_matches_numpy(spark, binned, rounds, depth):
    rows, _, cfg = binned
    some = rows.where("splits = 'TRAIN' AND date >= '1998-01-01'").cache()
    got = some.toPandas()
    x, day = global_gbt.expand(list(got["known"]), list(got["origins"]), cfg.horizon)
    y = got["label"].to_numpy()[day]
    forest = global_gbt.boost(some.repartition(3), x.shape[1], cfg.horizon, rounds, depth, 0.5, min_rows=5, size=1 << 20)
    assert len(y) > 200
    assert forest.predict(x) == pytest.approx(brute_boost(x, y, rounds, depth, 0.5, 5, (0.1, 0.3, 0.5, 0.7, 0.9)))


def test_rank_summary_bounds_its_error():
    rng = np.random.default_rng(3)
    v = rng.standard_cauchy(50_000)
    held = np.zeros(0), np.zeros(0, np.int64)
    for part in np.array_split(v, 20):
        held = global_gbt.summary(np.concatenate([held[0], part]), np.concatenate([held[1], np.ones(len(part), np.int64)]), 1000)
    assert len(held[0]) <= 1000 and held[1].sum() == len(v)
    for q in (0.1, 0.5, 0.9):
        assert abs((v <= global_gbt.weighted_quantile(*held, q)).mean() - q) < 0.01


def test_shifted_levels_cover_validate(spark, nation, tmp_path):
    """The model's own levels, with their shifts, cover their share of VALIDATE."""
    from panelcast.config import QUANTILES

    prepped, cfg = nation
    cfg = cfg.replace(horizon=4)
    model = global_gbt.fit_global(prepped, cfg, str(tmp_path / "m"), max_iter=3, max_depth=2)
    days = global_gbt.binned(global_gbt.day_rows(prepped, cfg), cfg, model.edges).where("splits = 'VALIDATE'").toPandas()
    x, day = global_gbt.expand(list(days["known"]), list(days["origins"]), cfg.horizon)
    shift = {r["h"]: r["shift"] for r in model.shifts.collect()}
    pred = model.forest.predict(x) + np.array([shift[h] for h in x[:, 0]])
    below = (days["label"].to_numpy()[day][:, None] < pred).mean(0)
    upto = (days["label"].to_numpy()[day][:, None] <= pred).mean(0)
    for k, q in enumerate(QUANTILES):
        assert below[k] - 0.03 <= q <= upto[k] + 0.03, (q, below[k], upto[k])


def test_seasonal_naive_matches_numpy(spark, nation):
    from panelcast.operators import contexts
    from panelcast.operators.forecast import zero_shot

    prepped, cfg = nation
    ctx = contexts.series_contexts(prepped, cfg)
    fc = zero_shot.seasonal_naive(ctx, cfg.horizon, 7, "m").toPandas()
    predict = zero_shot.seasonal_naive_predictor(7)
    for r in ctx.collect()[:5]:
        point, quant = predict([np.asarray(r["context"])], cfg.horizon)
        got = fc[fc.series == r["series"]].sort_values("horizon_step")
        assert got["forecast"].to_numpy() == pytest.approx(point[0])
        assert got["q90"].to_numpy() == pytest.approx(quant[0, :, 9])
        assert got["q10"].to_numpy() == pytest.approx(quant[0, :, 1])


