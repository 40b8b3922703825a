"""FC4/FC5: per-series regression on known-future covariates with AR(p)
errors, fitted as Spark aggregations.

Fit (``fit_xreg``), one pass over the train panel as it lies by series and day
(``whole_series``), in numpy over many whole series at a time:

1. features x = [1, regressors (NULL -> series train mean), holiday flag];
   per-series Gram sums  sum(x_i x_j), sum(x_i y)  -> ridge solve per series.
2. residuals r = y - x.beta; lags r_(t-1..t-P); per-series lag Gram
   the same way -> AR order p in 0..P by AIC from leading sub-blocks of one
   Gram (one pass serves every p), sigma^2 = SSE/m.

``gram_rows`` and ``error_model`` are the same two steps as Spark aggregations
(the sweep's fits and the stationarity's errors).

The model table (one row per series: beta, means, phi, sigma, last residuals,
last date) is the model reference (FC8): write it, read it, forecast later.

Forecast (``forecast_xreg``): future days last+1..last+H joined to the infer
regressors by (series, date) (JN10; of a day that infer lacks, the calendar comes
from the date and the weather from another series' row of that day), x.beta by ``zip_with``/``aggregate``,
AR recursion of the errors and psi-weight standard errors (non-decreasing in
the step), then Gaussian quantiles (PR14/PR15) and the step rank (WN2).
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...config import PanelConfig
from ..frames import from_point_stderr
from .future import with_covariates
from .holidays import holiday_flag
from .whole_series import Chunk, fitted, lag, regression, stored

MAX_P = 7
RIDGE = 1e-6


def _regressors(cfg: PanelConfig, regressors) -> list[str]:
    return list(cfg.roles.available if regressors is None else regressors)


def _feature_frame(frame: DataFrame, cfg: PanelConfig, regs: list[str]) -> DataFrame:
    s, t, y = cfg.series_column, cfg.time_column, cfg.target_column
    missing = [c for c in regs if c not in frame.columns]
    if missing:
        raise ValueError(f"regressors missing from the frame: {missing}")
    return frame.select(
        F.col(s).alias("series"),
        F.col(t).alias("date"),
        F.col(y).cast("double").alias("y"),
        *[F.col(c).cast("double").alias(c) for c in regs],
        holiday_flag(t, cfg.holiday_region).cast("double").alias("_holiday"),
    )


def _x(cols: list[str], means: str = "mu") -> F.Column:
    return F.array(F.lit(1.0), *[F.coalesce(F.col(c), F.col(means)[i]) for i, c in enumerate(cols)])


def _dot(a: F.Column, b: F.Column) -> F.Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda acc, v: acc + v)


def _gram_aggs(vec: str, target: str, k: int, prefix: str) -> list[F.Column]:
    v, yv = F.col(vec), F.col(target)
    pairs = [v[i] * v[j] for i in range(k) for j in range(i, k)]
    return [
        F.array(*[F.sum(p) for p in pairs]).alias(f"{prefix}_g"),
        F.array(*[F.sum(v[i] * yv) for i in range(k)]).alias(f"{prefix}_b"),
        F.sum(yv * yv).alias(f"{prefix}_yy"),
        F.count(yv).alias(f"{prefix}_n"),
    ]


def _unpack(tri: np.ndarray, k: int) -> np.ndarray:
    g = np.zeros((k, k))
    idx = 0
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = tri[idx]
            idx += 1
    return g


def _ridge_solve(g: np.ndarray, b: np.ndarray, n: int, ridge: float) -> np.ndarray:
    k = len(b)
    if n < k:  # too few points for the covariates: intercept only (the mean)
        beta = np.zeros(k)
        beta[0] = b[0] / g[0, 0] if g[0, 0] > 0 else 0.0
        return beta
    pen = np.diag(np.r_[0.0, np.full(k - 1, 1.0)]) * ridge * max(np.trace(g) / k, 1.0)
    try:
        return np.linalg.solve(g + pen, b)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(g + pen, b, rcond=None)[0]


BETA_SCHEMA = T.StructType(
    [
        T.StructField("series", T.StringType()),
        T.StructField("last_date", T.DateType()),
        T.StructField("n", T.LongType()),
        T.StructField("mu", T.ArrayType(T.DoubleType())),
        T.StructField("beta", T.ArrayType(T.DoubleType())),
    ]
)


def _solve_beta(k: int, ridge: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            betas = [
                _ridge_solve(_unpack(np.asarray(tri, float), k), np.asarray(b, float), int(n), ridge).tolist()
                for tri, b, n in zip(pdf["reg_g"], pdf["reg_b"], pdf["reg_n"])
            ]
            yield pd.DataFrame(
                {
                    "series": pdf["series"].values,
                    "last_date": pdf["last_date"].values,
                    "n": pdf["reg_n"].astype("int64").values,
                    "mu": pdf["mu"].values,
                    "beta": betas,
                }
            )

    return run


def select_ar(g: np.ndarray, b: np.ndarray, rr: float, m: int, max_p: int) -> tuple[np.ndarray, float]:
    """AR order by AIC over p = 0..max_p from one lag Gram (leading blocks)."""
    if m <= 0:
        return np.zeros(0), float("nan")
    best = (m * np.log(max(rr, 1e-12) / m), np.zeros(0), rr)
    for p in range(1, min(max_p, m - 2) + 1):  # every order that leaves a degree of freedom
        gp, bp = g[:p, :p], b[:p]
        try:
            phi = np.linalg.solve(gp + np.eye(p) * 1e-9 * max(np.trace(gp) / p, 1.0), bp)
        except np.linalg.LinAlgError:
            continue
        sse = rr - float(phi @ bp)
        if not np.isfinite(sse) or sse <= 0:
            continue
        aic = m * np.log(sse / m) + 2 * p
        if aic < best[0]:
            best = (aic, phi, sse)
    return best[1], best[2] / m


AR_SCHEMA = T.StructType(
    [
        T.StructField("series", T.StringType()),
        T.StructField("phi", T.ArrayType(T.DoubleType())),
        T.StructField("sigma", T.DoubleType()),
        T.StructField("last_resid", T.ArrayType(T.DoubleType())),
    ]
)


def _solve_ar(max_p: int, keys: tuple[str, ...] = ()):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            phis, sigmas, tails = [], [], []
            for tri, b, rr, m, ssr, nr, tail in zip(
                pdf["ar_g"], pdf["ar_b"], pdf["ar_yy"], pdf["ar_n"], pdf["res_ss"], pdf["res_n"], pdf["_tail"]
            ):
                if tri is None or m is None or int(m) == 0:
                    phi, s2 = np.zeros(0), (float(ssr) / int(nr) if nr else float("nan"))
                else:
                    phi, s2 = select_ar(_unpack(np.asarray(tri, float), max_p), np.asarray(b, float), float(rr), int(m), max_p)
                phis.append(phi.tolist())
                sigmas.append(float(np.sqrt(s2)) if np.isfinite(s2) else float("nan"))
                tails.append([float(v) for v in list(tail)[1:]])
            own = {k: pdf[k].values for k in keys}
            yield pd.DataFrame({"series": pdf["series"].values, "phi": phis, "sigma": sigmas, "last_resid": tails, **own})

    return run


def load_xreg(spark: SparkSession, path: str) -> DataFrame:
    """The model table that ``fit_xreg`` stored under ``path``: its reference."""
    return spark.read.parquet(path)


def error_model(res: DataFrame, max_p: int = MAX_P, keys: tuple[str, ...] = ()) -> DataFrame:
    """phi, sigma and the last residuals of each (series, *keys) from rows with ``date`` and the residual ``r``."""
    by_time = Window.partitionBy("series", *keys).orderBy("date")
    res = res.withColumn("lagv", F.array(*[F.lag("r", i).over(by_time) for i in range(1, max_p + 1)]))
    ok = F.forall("lagv", lambda v: v.isNotNull())
    lv, r = F.col("lagv"), F.col("r")
    ar = res.groupBy("series", *keys).agg(
        F.array(*[F.sum(F.when(ok, lv[i] * lv[j])) for i in range(max_p) for j in range(i, max_p)]).alias("ar_g"),
        F.array(*[F.sum(F.when(ok, lv[i] * r)) for i in range(max_p)]).alias("ar_b"),
        F.sum(F.when(ok, r * r)).alias("ar_yy"),
        F.count(F.when(ok, F.lit(1))).alias("ar_n"),
        F.sum(r * r).alias("res_ss"),
        F.count(r).alias("res_n"),
        # the last max_p residuals, oldest -> newest (unknown -> 0), plus one slot
        F.max_by(F.concat(F.array(F.lit(0.0)), F.reverse(F.transform("lagv", lambda v: F.coalesce(v, F.lit(0.0)))), F.array("r")), "date").alias("_tail"),
    )
    types = {f.name: f.dataType for f in res.schema.fields}
    schema = T.StructType([*AR_SCHEMA.fields, *[T.StructField(k, types[k]) for k in keys]])
    return ar.mapInPandas(_solve_ar(max_p, keys), schema)


def gram_rows(train: DataFrame, cfg: PanelConfig, regressors=None) -> DataFrame:
    """Per series the Gram sums of [1, regressors, holiday] with the target, the means that stand for missing values, and the last
    day. Over the stored panel (bucketed by series) no row is shuffled."""
    feats, k = _features(train, cfg, _regressors(cfg, regressors))
    return feats.groupBy("series").agg(*_gram_aggs("x", "y", k, "reg"), F.max("mu").alias("mu"), F.max("date").alias("last_date"))


def _features(train: DataFrame, cfg: PanelConfig, regs: list[str]) -> tuple[DataFrame, int]:
    cols = [*regs, "_holiday"]
    base = _feature_frame(train, cfg, regs).where(F.col("y").isNotNull())
    # means by a partial aggregation and a hash join (a row per series): the panel's rows keep their place and order
    means = base.groupBy("series").agg(F.array(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in cols]).alias("mu"))
    return base.join(means.hint("shuffle_hash"), "series").withColumn("x", _x(cols)), len(cols) + 1


FIT_DDL = "series string, last_date date, n long, mu array<double>, beta array<double>, phi array<double>, sigma double, last_resid array<double>"
_DOUBLES = pa.list_(pa.float64())
FIT_ARROW = pa.schema({
    "series": pa.string(), "last_date": pa.date32(), "n": pa.int64(), "mu": _DOUBLES, "beta": _DOUBLES, "phi": _DOUBLES, "sigma": pa.float64(),
    "last_resid": _DOUBLES,
})


def _error_sums(chunk: Chunk, cols: list[str], ridge: float, max_p: int) -> dict:
    """The regression of whole series and what ``error_model`` sums over its errors."""
    found, r = regression(chunk, cols, lambda g, b, n: _ridge_solve(g, b, n, ridge))
    unknown = np.flatnonzero(chunk.at < max_p)
    target = r.copy()
    target[unknown] = 0.0
    g, b = chunk.gram([lag(r, k, unknown) for k in range(1, max_p + 1)], target)
    # oldest first, one more than the longest lag
    tail = chunk.tail(r, max_p + 1)[:, ::-1]
    return found | {
        "ar_g": g, "ar_b": b, "ar_yy": chunk.sums(target * target), "ar_n": np.maximum(chunk.length - max_p, 0), "res_ss": chunk.sums(r * r),
        "last_resid": tail,
    }


def _solve_errors(found: dict, max_p: int) -> dict:
    phis, sigmas = [], []
    for g, b, rr, m, ss, n in zip(*(found[c] for c in ("ar_g", "ar_b", "ar_yy", "ar_n", "res_ss", "n")), strict=True):
        phi, s2 = select_ar(g, b, float(rr), int(m), max_p) if m else (np.zeros(0), float(ss) / int(n))
        phis.append(phi.tolist())
        sigmas.append(float(np.sqrt(s2)) if np.isfinite(s2) else float("nan"))
    return found | {"phi": phis, "sigma": sigmas}


def fit_xreg(
    train: DataFrame, cfg: PanelConfig, regressors=None, ridge: float = RIDGE, max_p: int = MAX_P, model_path: str | None = None
) -> DataFrame:
    """Model table: series, last_date, n, mu, beta, phi, sigma, last_resid,
    regressors -- one row per series, written once, to ``model_path`` where one
    is given (the reference for ``load_xreg``) and else to the shared folder."""
    regs = _regressors(cfg, regressors)
    cols = [*regs, "_holiday"]
    rows = _feature_frame(train, cfg, regs).where(F.col("y").isNotNull())
    fits = fitted(rows, FIT_ARROW, FIT_DDL, lambda chunk: _error_sums(chunk, cols, ridge, max_p), lambda found: _solve_errors(found, max_p))
    model = fits.withColumn("regressors", F.array(*[F.lit(c) for c in regs]))
    return stored(model, model_path, "xreg-model")


PATH_SCHEMA = T.StructType(
    [
        T.StructField("series", T.StringType()),
        T.StructField("e_path", T.ArrayType(T.DoubleType())),
        T.StructField("se_path", T.ArrayType(T.DoubleType())),
    ]
)


def ar_paths(phi: np.ndarray, tail: np.ndarray, sigma: float, horizon: int) -> tuple[list[float], list[float]]:
    """Error forecasts e_(T+1..T+H) and standard errors sigma*sqrt(sum psi_j^2)."""
    p = len(phi)
    hist = list(tail)
    e = []
    for _ in range(horizon):
        nxt = sum(phi[i] * hist[-1 - i] for i in range(p)) if p else 0.0
        hist.append(nxt)
        e.append(float(nxt))
    psi = [1.0]
    for j in range(1, horizon):
        psi.append(sum(phi[i - 1] * psi[j - i] for i in range(1, min(j, p) + 1)))
    cum = np.sqrt(np.cumsum(np.square(psi)))
    s = sigma if np.isfinite(sigma) else 0.0
    return e, [float(s * c) for c in cum]


def _paths(horizon: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            es, ses = [], []
            for phi, tail, sigma in zip(pdf["phi"], pdf["last_resid"], pdf["sigma"]):
                e, se = ar_paths(np.asarray(phi, float), np.asarray(tail, float), float(sigma), horizon)
                es.append(e)
                ses.append(se)
            yield pd.DataFrame({"series": pdf["series"].values, "e_path": es, "se_path": ses})

    return run


def forecast_xreg_raw(
    model: DataFrame, future: DataFrame, cfg: PanelConfig, horizon: int | None = None, regressors=None,
    confidence: float = 0.9, paths: DataFrame | None = None,
) -> DataFrame:
    """Point forecasts with their uncertainty: series, forecast_timestamp, forecast_value, standard_error,
    confidence_level and the bounds of the central interval of that probability.
    ``regressors`` must be the list the model was fitted with (default: roles). ``paths`` (series, e_path, se_path) are the
    errors' forecasts of another error model over the same regression."""
    if not 0 < confidence < 1:
        raise ValueError(f"confidence must lie between 0 and 1: {confidence}")
    z = NormalDist().inv_cdf((1 + confidence) / 2)
    h = horizon or cfg.horizon
    reg_names = _regressors(cfg, regressors)
    cols = [*reg_names, "_holiday"]
    if paths is None:
        paths = model.select("series", "phi", "last_resid", "sigma").mapInPandas(_paths(h), PATH_SCHEMA)
    steps = model.join(paths, "series").select(
        "series", "mu", "beta", "e_path", "se_path", F.posexplode(F.sequence(F.lit(1), F.lit(h))).alias("_i", "h"),
        "last_date",
    ).withColumn("date", F.date_add("last_date", F.col("h")))
    joined = with_covariates(steps, future, cfg, reg_names).withColumn("_holiday", holiday_flag("date", cfg.holiday_region).cast("double"))
    x = _x(cols)
    out = joined.select(
        "series",
        F.col("date").cast("timestamp_ntz").alias("forecast_timestamp"),
        (_dot(x, F.col("beta")) + F.col("e_path")[F.col("_i")]).alias("forecast_value"),
        F.col("se_path")[F.col("_i")].alias("standard_error"),
    )
    half = F.lit(z) * F.col("standard_error")
    return out.select(
        "*",
        F.lit(confidence).alias("confidence_level"),
        (F.col("forecast_value") - half).alias("prediction_interval_lower_bound"),
        (F.col("forecast_value") + half).alias("prediction_interval_upper_bound"),
    )


def forecast_xreg(
    model: DataFrame, future: DataFrame, cfg: PanelConfig, model_name: str = "xreg", horizon: int | None = None,
    regressors=None,
) -> DataFrame:
    """Standard long prediction frame (Gaussian quantiles around the point)."""
    return from_point_stderr(forecast_xreg_raw(model, future, cfg, horizon, regressors), "series", model_name)


# One-regressor variant, closed form (the oracle-checkable special case).
def fit_one_regressor(train: DataFrame, cfg: PanelConfig, x: str = "temp") -> DataFrame:
    s, y = cfg.series_column, cfg.target_column
    return train.groupBy(F.col(s).alias("series")).agg(
        F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
        F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
        F.regr_count(F.col(y).cast("double"), F.col(x).cast("double")).alias("n"),
    )
