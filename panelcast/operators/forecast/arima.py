"""FC4/FC5 with differences and moving-average errors: per-series regression whose errors follow a seasonal ARMA after
differencing. The fit is one pass over the panel as it lies by series and day (``whole_series``): sums by series in numpy over many
whole series at a time, then the small solves. ``errors``, ``stationarity`` and ``differenced`` are its first steps as Spark plans.

1. regression as in ``xreg`` (Gram sums, ridge solve); errors r.
2. stationarity: the KPSS statistic of r (cumulative sums against the long-run variance, Bartlett weights) asks for first
   differences x beyond ``KPSS_5`` (its 5 % point); the share of x's variance that lies between weekdays asks for weekly differences
   w beyond ``SEASONAL``.
3. Hannan-Rissanen: a long autoregression of w (lags 1 to ``LONG``, lag Gram) gives innovations e; then one Gram of
   [1, w at AR_LAGS, e at MA_LAGS] serves every order as sub-blocks: ordinary lags up to p and q and the weekly lag on or off, the
   least AIC of those whose autoregression is stationary.

Forecast: the recursion of w, undone differences, psi weights of the whole operator for the standard errors.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...config import PanelConfig
from ..frames import from_point_stderr
from .whole_series import Chunk, dot, fitted, lag, regression, stored
from .xreg import (
    BETA_SCHEMA, PATH_SCHEMA, RIDGE, _dot, _feature_frame, _features, _regressors, _ridge_solve, _solve_beta, forecast_xreg_raw, gram_rows,
)

WEEK, LONG = 7, 8
AR_LAGS, MA_LAGS = (1, 2, 3, WEEK), (1, 2, WEEK)
#: Fixed value: the KPSS statistic's 5 % point for a level. Share of variance between weekdays from which weeks are differenced.
KPSS_5, SEASONAL = 0.463, 0.4
MAX_BANDWIDTH = 12
TINY = 1e-9


# -- 2: stationarity -------------------------------------------------------------
def errors(train: DataFrame, cfg: PanelConfig, regressors=None, ridge: float = RIDGE) -> tuple[DataFrame, DataFrame]:
    """(beta table, errors of the regression: series, date, r)."""
    from ...sources.tables import materialize

    regs = _regressors(cfg, regressors)
    feats, k = _features(train, cfg, regs)
    beta = materialize(gram_rows(train, cfg, regs).mapInPandas(_solve_beta(k, ridge), BETA_SCHEMA), "arima-beta")
    r = F.col("y") - _dot(F.col("x"), F.col("beta"))
    return beta, feats.join(beta.select("series", "beta").hint("shuffle_hash"), "series").select("series", "date", r.alias("r"))


def stationarity(res: DataFrame) -> DataFrame:
    """series, n, kpss, d (0 or 1), strength, seasonal (0 or 1)."""
    by_time = Window.partitionBy("series").orderBy("date")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, 0)
    walk = res.select(
        "series", "date", "r", F.sum("r").over(so_far).alias("s"), (F.col("r") - F.lag("r").over(by_time)).alias("dr"),
        *[F.lag("r", k).over(by_time).alias(f"r{k}") for k in range(1, MAX_BANDWIDTH + 1)],
    )
    day = F.dayofweek("date")
    groups = lambda c: [F.array(*[F.sum(F.when(day == k, F.col(c))) for k in range(1, 8)]), F.array(*[F.count(F.when(day == k, F.col(c))) for k in range(1, 8)])]
    names = ("r_sum", "r_n", "dr_sum", "dr_n")
    sums = walk.groupBy("series").agg(
        F.count("r").alias("n"), F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum("r").alias("sr"), F.sum("dr").alias("sdr"),
        F.sum(F.col("r") * F.col("r")).alias("g0"), F.sum(F.col("dr") * F.col("dr")).alias("dd"),
        F.array(*[F.coalesce(F.sum(F.col("r") * F.col(f"r{k}")), F.lit(0.0)) for k in range(1, MAX_BANDWIDTH + 1)]).alias("g"),
        *[c.alias(n) for c, n in zip([*groups("r"), *groups("dr")], names, strict=True)],
    )
    n = F.col("n")
    width = F.least(F.floor(4 * F.pow(n / 100.0, F.lit(0.25))), F.lit(MAX_BANDWIDTH))
    weighted = F.aggregate(
        F.transform("g", lambda g, k: F.when(k < width, 2 * (1 - (k + 1) / (width + 1)) * g).otherwise(F.lit(0.0))), F.lit(0.0), lambda a, v: a + v
    )
    long_run = (F.col("g0") + weighted) / n
    kpss = F.when(long_run > TINY, F.col("ss") / (n * n) / long_run).otherwise(F.lit(0.0))

    def strength(total: str, squares: str, by_day: str, counts: str) -> F.Column:
        m = F.aggregate(counts, F.lit(0).cast("long"), lambda a, v: a + v)
        between = F.aggregate(
            F.zip_with(by_day, counts, lambda s, c: F.when(c > 0, s * s / c).otherwise(F.lit(0.0))), F.lit(0.0), lambda a, v: a + v
        ) - F.col(total) * F.col(total) / m
        whole = F.col(squares) - F.col(total) * F.col(total) / m
        return F.when((m > 0) & (whole > TINY), between / whole).otherwise(F.lit(0.0))

    out = sums.withColumn("kpss", kpss).withColumn("d", F.when(F.col("kpss") > KPSS_5, 1).otherwise(0))
    share = F.when(F.col("d") == 1, strength("sdr", "dd", "dr_sum", "dr_n")).otherwise(strength("sr", "g0", "r_sum", "r_n"))
    out = out.withColumn("strength", share)
    # a season takes several weeks to show
    seasonal = F.when((F.col("strength") > SEASONAL) & (n >= 6 * WEEK), 1).otherwise(0)
    return out.select("series", "n", "kpss", "d", "strength", seasonal.alias("seasonal"))


def differenced(res: DataFrame, kinds: DataFrame) -> DataFrame:
    """series, date, r, x (after first differences, where asked for) and w (after weekly ones too)."""
    by_time = Window.partitionBy("series").orderBy("date")
    x = F.when(F.col("d") == 1, F.col("r") - F.lag("r").over(by_time)).otherwise(F.col("r"))
    out = res.join(kinds.select("series", "d", "seasonal").hint("shuffle_hash"), "series").withColumn("x", x)
    w = F.when(F.col("seasonal") == 1, F.col("x") - F.lag("x", WEEK).over(by_time)).otherwise(F.col("x"))
    return out.withColumn("w", w).select("series", "date", "r", "x", "w")


# -- 3: Hannan-Rissanen -------------------------------------------------------------
def _solve(g: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of every series (the first axis)."""
    k = b.shape[1]
    size = np.maximum(np.trace(g, axis1=1, axis2=2) / k, 1.0)
    return np.linalg.solve(g + np.eye(k) * TINY * size[:, None, None], b[..., None])[..., 0]


def orders() -> list[tuple[int, ...]]:
    """Places in [1, w at AR_LAGS, e at MA_LAGS] of every order, the fewest terms first."""
    n_ar, n_ma = len(AR_LAGS), len(MA_LAGS)
    found = []
    for p, q, sp, sq in itertools.product(range(n_ar), range(n_ma), (0, 1), (0, 1)):
        ar = [*range(1, p + 1), *([n_ar] if sp else [])]
        ma = [*range(n_ar + 1, n_ar + 1 + q), *([n_ar + n_ma] if sq else [])]
        found.append((0, *ar, *ma))
    return sorted(found, key=lambda o: (len(o), o))


def dense(order: tuple[int, ...], c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(constant, AR coefficients by lag 1..WEEK, MA coefficients by lag), of one series or of each row of ``c``."""
    const, ar, ma = np.zeros(c.shape[:-1]), np.zeros((*c.shape[:-1], WEEK)), np.zeros((*c.shape[:-1], WEEK))
    for i, place in enumerate(order):
        if place == 0:
            const = c[..., i][()]
        elif place <= len(AR_LAGS):
            ar[..., AR_LAGS[place - 1] - 1] = c[..., i]
        else:
            ma[..., MA_LAGS[place - 1 - len(AR_LAGS)] - 1] = c[..., i]
    return const, ar, ma


def steady(coefficients: np.ndarray) -> np.ndarray:
    """Whether the recursion with these coefficients (or each row of them) dies out (companion matrix)."""
    m = np.zeros((*coefficients.shape[:-1], WEEK, WEEK))
    m[..., 0, :] = coefficients
    m[..., 1:, :-1] = np.eye(WEEK - 1)
    return np.abs(np.linalg.eigvals(m)).max(axis=-1) < 0.995


def choose(g: np.ndarray, b: np.ndarray, ww: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(constant, ar, ma, sigma) by series: the least AIC among the orders that are steady both ways. Every order is solved for all
    series at once."""
    n = len(m)
    best, const, ar, ma = np.full(n, np.inf), np.zeros(n), np.zeros((n, WEEK)), np.zeros((n, WEEK))
    sigma = np.sqrt(np.maximum(ww, 0.0) / np.maximum(m, 1))
    for order in orders():
        enough = np.flatnonzero(m >= len(order) + 2)
        if not len(enough):
            continue
        at = np.array(order)
        go, bo, mo = g[enough][:, at[:, None], at], b[enough][:, at], m[enough]
        c = _solve(go, bo)
        sse = ww[enough] - (2 * (c * bo).sum(axis=1) - np.einsum("si,sij,sj->s", c, go, c))
        fits = np.isfinite(sse) & (sse > 0)
        aic = mo * np.log(np.where(fits, sse, 1.0) / mo) + 2 * len(order)
        better = np.flatnonzero(fits & (aic < best[enough] - 1e-9))
        consts, ars, mas = dense(order, c[better])
        holds = steady(ars)
        holds[holds] = steady(-mas[holds])
        kept = better[holds]
        to = enough[kept]
        best[to], const[to], ar[to], ma[to], sigma[to] = aic[kept], consts[holds], ars[holds], mas[holds], np.sqrt(sse[kept] / mo[kept])
    return const, ar, ma, sigma


FIT_DDL = (
    "series string, last_date date, n long, mu array<double>, beta array<double>, d int, seasonal int, kpss double, strength double, const double, "
    "ar array<double>, ma array<double>, sigma double, last_r double, last_x array<double>, last_w array<double>, last_e array<double>"
)
_DOUBLES = pa.list_(pa.float64())
FIT_ARROW = pa.schema({
    "series": pa.string(), "last_date": pa.date32(), "n": pa.int64(), "mu": _DOUBLES, "beta": _DOUBLES, "d": pa.int32(), "seasonal": pa.int32(),
    "kpss": pa.float64(), "strength": pa.float64(), "const": pa.float64(), "ar": _DOUBLES, "ma": _DOUBLES, "sigma": pa.float64(), "last_r": pa.float64(),
    "last_x": _DOUBLES, "last_w": _DOUBLES, "last_e": _DOUBLES,
})


def _kinds(chunk: Chunk, r: np.ndarray, dr: np.ndarray) -> dict:
    """``stationarity`` of whole series; ``dr`` (the errors' first differences) is 0 on a series' first day. As in Spark NaN is
    beyond every bound."""
    n, g0 = chunk.length, chunk.sums(r * r)
    width = np.minimum(np.floor(4 * np.power(n / 100.0, 0.25)), MAX_BANDWIDTH)
    head = np.flatnonzero(chunk.at < MAX_BANDWIDTH)
    long_run = g0.copy()
    for k in range(1, int(width.max()) + 1):
        g = chunk.sums(r * lag(r, k, head[chunk.at[head] < k]))
        long_run += np.where(k <= width, 2 * (1 - k / (width + 1)) * g, 0.0)
    long_run /= n
    s = chunk.running(r)
    some = ~(long_run <= TINY)
    kpss = np.where(some, chunk.sums(s * s) / (n * n) / np.where(some, long_run, 1.0), 0.0)
    d = ~(kpss <= KPSS_5)

    series = chunk.rows(np.arange(len(n)))
    cell = series * WEEK + (chunk.days() + 4) % WEEK  # by weekday
    by_day = lambda v=None: np.bincount(cell, v, len(n) * WEEK).reshape(-1, WEEK)
    counts = by_day()
    later = counts - np.bincount(cell[chunk.start], minlength=len(n) * WEEK).reshape(-1, WEEK)

    def strength(total, squares, sums, counts):
        m = counts.sum(axis=1)
        mean = total * total / np.maximum(m, 1)
        between = np.where(counts > 0, sums * sums / np.maximum(counts, 1), 0.0).sum(axis=1) - mean
        whole = squares - mean
        some = (m > 0) & ~(whole <= TINY)
        return np.where(some, between / np.where(some, whole, 1.0), 0.0)

    share = np.where(
        d, strength(chunk.sums(dr), chunk.sums(dr * dr), by_day(dr), later), strength(chunk.sums(r), g0, by_day(r), counts)
    )
    return {"kpss": kpss, "d": d.astype(np.int32), "strength": share, "seasonal": (~(share <= SEASONAL) & (n >= 6 * WEEK)).astype(np.int32)}


def _sums(chunk: Chunk, cols: list[str], ridge: float) -> dict:
    """Steps 1 to 3 of whole series up to the Gram of every order. Values that are not known are 0 and counted nowhere."""
    found, r = regression(chunk, cols, lambda g, b, n: _ridge_solve(g, b, n, ridge))
    dr = r - lag(r, 1, chunk.start)
    dr[chunk.start] = 0.0
    kinds = _kinds(chunk, r, dr)
    d, seasonal, n = kinds["d"], kinds["seasonal"], chunk.length
    lost = d + WEEK * seasonal  # days without w
    head = np.flatnonzero(chunk.at < 1 + WEEK + LONG + max(MA_LAGS))
    known = chunk.at[head] - chunk.rows(lost)[head]  # days of w before
    before = lambda k: head[known < k]

    def at_zero(v: np.ndarray, unknown: np.ndarray) -> np.ndarray:
        out = v.copy()
        out[unknown] = 0.0
        return out

    x = np.where(chunk.rows(d) == 1, dr, r)
    w = at_zero(np.where(chunk.rows(seasonal) == 1, x - lag(x, WEEK, head[chunk.at[head] < WEEK]), x), before(0))
    # the long autoregression's innovations
    unknown, ones = before(LONG), np.ones(len(r))
    vs = [at_zero(ones, unknown), *[lag(w, k, unknown) for k in range(1, LONG + 1)]]
    g, b = chunk.gram(vs, w)
    a = np.zeros(b.shape)
    enough = n - lost - LONG >= 3 * (LONG + 1)
    a[enough] = _solve(g[enough], b[enough])
    e = at_zero(w - dot(vs, a, chunk), unknown)
    # the Gram that serves every order
    unknown = before(LONG + max(MA_LAGS))
    target = at_zero(w, unknown)
    vs = [at_zero(ones, unknown), *[lag(w, k, unknown) for k in AR_LAGS], *[lag(e, k, unknown) for k in MA_LAGS]]
    g, b = chunk.gram(vs, target)
    off = r - chunk.rows(chunk.sums(r) / n)
    return found | kinds | {
        "lag_g": g, "lag_b": b, "lag_yy": chunk.sums(target * target), "lag_n": np.maximum(n - lost - LONG - max(MA_LAGS), 0),
        "spread": np.sqrt(chunk.sums(off * off) / n), "last_r": r[chunk.last],
        "last_x": chunk.tail(x, WEEK), "last_w": chunk.tail(w, WEEK), "last_e": chunk.tail(e, WEEK),
    }


def _arma(found: dict) -> dict:
    m = found["lag_n"]
    const, ar, ma, sigma = choose(found["lag_g"], found["lag_b"], found["lag_yy"], m)
    return found | {"const": const, "ar": ar, "ma": ma, "sigma": np.where(m > 0, sigma, found["spread"])}


def fit_arima(train: DataFrame, cfg: PanelConfig, regressors=None, ridge: float = RIDGE, model_path: str | None = None) -> DataFrame:
    """Model table, a row per series: series, last_date, n, mu, beta, d, seasonal, kpss, strength, const, ar, ma, sigma and the
    last values of r, x, w and e that the recursion starts from (newest first); written once, to ``model_path`` or the shared folder."""
    regs = _regressors(cfg, regressors)
    cols = [*regs, "_holiday"]
    rows = _feature_frame(train, cfg, regs).where(F.col("y").isNotNull())
    model = fitted(rows, FIT_ARROW, FIT_DDL, lambda chunk: _sums(chunk, cols, ridge), _arma)
    return stored(model, model_path, "arima-model")


# -- forecast ---------------------------------------------------------------------
def arima_path(d: int, seasonal: int, const: float, ar, ma, sigma: float, last_r: float, last_x, last_w, last_e, horizon: int) -> tuple[list[float], list[float]]:
    """Forecasts of the regression's error and their standard errors."""
    ar, ma = np.asarray(ar, float), np.asarray(ma, float)
    w, e = list(np.asarray(last_w, float)), list(np.asarray(last_e, float))  # newest first
    x, r, out = list(np.asarray(last_x, float)), float(last_r), []
    impulse_w, impulse_x, impulse_r, psi = [0.0] * WEEK, [0.0] * WEEK, 0.0, []
    for h in range(horizon):
        now = const + float(ar @ w[:WEEK]) + float(ma @ e[:WEEK])
        w, e = [now, *w[: WEEK - 1]], [0.0, *e[: WEEK - 1]]
        step = now + (x[WEEK - 1] if seasonal else 0.0)
        x = [step, *x[: WEEK - 1]]
        r = r + step if d else step
        out.append(r)
        # the same operator on a single shock at h = 0
        shock = (1.0 if h == 0 else 0.0) + float(ar @ impulse_w) + (ma[h - 1] if 0 < h <= WEEK else 0.0)
        impulse_w = [shock, *impulse_w[: WEEK - 1]]
        moved = shock + (impulse_x[WEEK - 1] if seasonal else 0.0)
        impulse_x = [moved, *impulse_x[: WEEK - 1]]
        impulse_r = impulse_r + moved if d else moved
        psi.append(impulse_r)
    return [float(v) for v in out], [float(sigma * s) for s in np.sqrt(np.cumsum(np.square(psi)))]


def _paths(horizon: int):
    columns = ["d", "seasonal", "const", "ar", "ma", "sigma", "last_r", "last_x", "last_w", "last_e"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [arima_path(*row, horizon) for row in zip(*(pdf[c] for c in columns), strict=True)]
            yield pd.DataFrame({"series": pdf["series"].values, "e_path": [e for e, _ in found], "se_path": [s for _, s in found]})

    return run


def forecast_arima(model: DataFrame, future: DataFrame, cfg: PanelConfig, model_name: str = "arima", horizon: int | None = None,
                   regressors=None) -> DataFrame:
    """Standard long prediction frame (Gaussian quantiles around the point)."""
    paths = model.mapInPandas(_paths(horizon or cfg.horizon), PATH_SCHEMA)
    return from_point_stderr(forecast_xreg_raw(model, future, cfg, horizon, regressors, paths=paths), "series", model_name)
