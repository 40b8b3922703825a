"""Zero-shot (no fit) forecasters over per-series contexts.

FC2 ``seasonal_naive``   pure column expressions, no Python: with n values,
    period p and k = ceil(h / p), forecast(h) = ctx[n - p*k + h] (1-based) and
    the q-quantile = forecast + quantile_q{ y_t - y_(t - p*k) } over the context
    (continuous/linear quantile). n < p*k -> last value, zero spread; no
    differences -> zero spread. p = 7 is the weekly naive; p = 1 the last value.
FC1 ``forecast_contexts`` the batched model slot: ``mapInPandas`` over batches
    of series; the predictor is built once per Python worker and receives a
    list of context arrays, returning point (n, h) and quantiles (n, h, c).
FC3 ``normalize_contexts`` / ``fix_quantile_crossing``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...config import QUANTILE_COLUMNS, QUANTILES, PanelConfig
from ...functions.scalar import array_quantile, pick_channel
from ..contexts import expand_horizon


# -- FC2 --------------------------------------------------------------------
def seasonal_naive(contexts: DataFrame, horizon: int, period: int = 7, model: str = "seasonal_naive") -> DataFrame:
    """Long prediction frame from contexts, all JVM-side expressions."""
    return seasonal_naive_models(contexts, horizon, {model: period})


def _lag(h: int, period: int) -> int:
    return -(-h // period) * period


def seasonal_naive_models(
    contexts: DataFrame,
    horizon: int,
    periods: dict[str, int],
    keys: tuple[str, ...] = (),
    horizon_col: str | None = None,
) -> DataFrame:
    """Several seasonal-naive models (model name -> period) in one pass over
    the contexts. The differences y_t - y_(t-L) depend only on the lag L, so
    their quantiles are computed once per (series, distinct lag) and each
    (model, step) row just indexes them; contexts are built once, no union.
    ``keys`` are carried through; ``horizon_col`` caps the steps per row
    (``horizon`` is then the largest value)."""
    ctx, n = F.col("context"), F.col("n")
    lags = sorted({_lag(h, p) for p in periods.values() for h in range(1, horizon + 1)})
    lag_pos = {L: i for i, L in enumerate(lags)}

    def diffs(L):
        return F.when(
            n > L,
            F.transform(F.sequence(L + 1, n), lambda t: F.element_at(ctx, t) - F.element_at(ctx, t - L)),
        ).otherwise(F.array().cast("array<double>"))

    sorted_diffs = F.transform(F.array(*[F.lit(L) for L in lags]), lambda L: F.array_sort(diffs(L)))
    spreads = F.transform(
        sorted_diffs,
        lambda srt: F.array(
            *[F.coalesce(array_quantile(srt, q, presorted=True), F.lit(0.0)) for q in QUANTILES]
        ),
    )
    combos = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"),
                F.lit(h).alias("h"),
                F.lit(_lag(h, p)).alias("_lag"),
                F.lit(lag_pos[_lag(h, p)]).alias("_li"),
            )
            for m, p in periods.items()
            for h in range(1, horizon + 1)
        ]
    )
    cap = [horizon_col] if horizon_col else []
    base = contexts.where(F.col("n") > 0).select(*keys, *cap, "series", "context", "n", "last_date", spreads.alias("_sp"))
    zero = F.array(*[F.lit(0.0) for _ in QUANTILES])

    def step(c):
        # all of one step, so that the explode carries scalars and never the context
        enough = n >= c["_lag"]
        point = F.element_at(ctx, F.when(enough, n - c["_lag"] + c["h"]).otherwise(n)).cast("double")
        spread = F.when(enough, F.element_at(F.col("_sp"), c["_li"] + 1)).otherwise(zero)
        return F.struct(c["model"].alias("model"), c["h"].alias("h"), point.alias("point"), spread.alias("spread"))

    wanted = F.filter(combos, lambda c: c["h"] <= F.col(horizon_col)) if horizon_col else combos
    steps = base.select(*keys, "series", "last_date", F.explode(F.transform(wanted, step)).alias("_s"))
    return steps.select(
        *keys,
        "series",
        F.date_add("last_date", F.col("_s.h")).alias("date"),
        F.col("_s.h").cast("int").alias("horizon_step"),
        F.col("_s.point").alias("forecast"),
        *[(F.col("_s.point") + F.col("_s.spread")[i]).alias(c) for i, c in enumerate(QUANTILE_COLUMNS)],
        F.col("_s.model").cast("string").alias("model"),
    )


# -- FC3 --------------------------------------------------------------------
def normalize_contexts(contexts: DataFrame) -> DataFrame:
    """(x - mean) / std per context (std 0 -> 1), keeping mean and std to undo."""
    # One pass for (sum, sum of squares); the statistics are zipped next to the
    # values so the optimizer cannot re-evaluate them once per element.
    n = F.size("context").cast("double")
    sums = F.aggregate(
        "context",
        F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("ss")),
        lambda acc, x: F.struct((acc["s"] + x).alias("s"), (acc["ss"] + x * x).alias("ss")),
    )
    out = contexts.withColumn("_sums", sums)
    mean = F.col("_sums.s") / n
    var = F.greatest(F.col("_sums.ss") / n - mean * mean, F.lit(0.0))
    out = out.withColumn("ctx_mean", mean).withColumn(
        "ctx_std", F.when(F.sqrt(var) > 0, F.sqrt(var)).otherwise(F.lit(1.0))
    )
    stats = F.struct(F.col("ctx_mean").alias("m"), F.col("ctx_std").alias("sd"))
    zipped = F.arrays_zip(F.col("context").alias("v"), F.array_repeat(stats, F.size("context")).alias("st"))
    normed = F.transform(zipped, lambda z: (z["v"] - z["st"]["m"]) / z["st"]["sd"])
    return out.withColumn("context", normed).drop("_sums")


def fix_quantile_crossing(preds: DataFrame) -> DataFrame:
    """Sort the five quantiles per row so q10 <= q30 <= ... <= q90."""
    s = F.array_sort(F.array(*[F.col(c) for c in QUANTILE_COLUMNS]))
    return preds.select(
        *[c for c in preds.columns if c not in QUANTILE_COLUMNS and c != "model"],
        *[s[i].alias(c) for i, c in enumerate(QUANTILE_COLUMNS)],
        *(["model"] if "model" in preds.columns else []),
    )


# -- FC1 --------------------------------------------------------------------
Predictor = Callable[[list[np.ndarray], int], tuple[np.ndarray, np.ndarray]]

# The ten channels of a quantile head (mean, then deciles 0.1..0.9).
DECILES = tuple(round(0.1 * i, 1) for i in range(1, 10))


def seasonal_naive_predictor(period: int = 7) -> Predictor:
    """numpy twin of FC2 emitting a ten-channel head (mean + deciles)."""

    def predict(inputs: list[np.ndarray], horizon: int) -> tuple[np.ndarray, np.ndarray]:
        point = np.zeros((len(inputs), horizon))
        quant = np.zeros((len(inputs), horizon, 10))
        steps = np.arange(1, horizon + 1)
        lags = -(-steps // period) * period
        by_length: dict[int, list[int]] = {}
        for i, ctx in enumerate(inputs):
            by_length.setdefault(len(ctx), []).append(i)
        for n, at in by_length.items():  # series of one length together, quantiles once per lag
            x = np.stack([np.asarray(inputs[i], dtype=float) for i in at])
            for lag in np.unique(lags):
                h = steps[lags == lag]
                if n >= lag:
                    f = x[:, n - lag + h - 1]
                else:
                    f = np.repeat(x[:, -1:], len(h), axis=1)
                spread = np.quantile(x[:, lag:] - x[:, :-lag], DECILES, axis=1).T if n > lag else np.zeros((len(at), 9))
                point[np.ix_(at, h - 1)] = f
                quant[np.ix_(at, h - 1, [0])] = f[:, :, None]
                quant[np.ix_(at, h - 1, range(1, 10))] = f[:, :, None] + spread[:, None, :]
        return point, quant

    return predict


#: What a predictor is built by: called once per Python worker, on first use.
Factory = Callable[[], Predictor]
BUILT_IN: dict[str, Factory] = {
    "seasonal_naive": lambda: seasonal_naive_predictor(7),
    "last_value": lambda: seasonal_naive_predictor(1),
}
# By key: a fresh one for every call of forecast_contexts, so that two factories never share a predictor.
_PREDICTORS: dict[str, Predictor] = {}


def _built(key: str, factory: Factory) -> Predictor:
    if key not in _PREDICTORS:
        _PREDICTORS.clear()
        _PREDICTORS[key] = factory()
    return _PREDICTORS[key]


RAW_RESPONSE = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("last_date", T.DateType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("forecast", T.ArrayType(T.DoubleType())),
        T.StructField("channels", T.ArrayType(T.ArrayType(T.DoubleType()))),
    ]
)


def forecast_contexts(contexts: DataFrame, horizon: int, predictor: str | Factory = "seasonal_naive") -> DataFrame:
    """Batched inference: one response per series (point array + channel arrays
    per step). Runs in Arrow batches; ``last_date`` (and the normalisation
    statistics, when present) travel with the batch.

    ``predictor``: a built-in name, or the caller's own factory, which travels
    to the workers with the task and is called once in each."""
    factory = BUILT_IN[predictor] if isinstance(predictor, str) else predictor
    key = uuid.uuid4().hex
    carry = [c for c in ("ctx_mean", "ctx_std") if c in contexts.columns]
    schema = T.StructType(RAW_RESPONSE.fields + [T.StructField(c, T.DoubleType()) for c in carry])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = _built(key, factory)
        for pdf in batches:
            if pdf.empty:
                continue
            inputs = [np.asarray(c, dtype=float) for c in pdf["context"]]
            point, quant = predict(inputs, horizon)
            out = {
                "series_id": pdf["series"].astype(str).values,
                "last_date": pdf["last_date"].values,
                "horizon": np.full(len(pdf), horizon, dtype=np.int32),
                "forecast": [row.tolist() for row in point],
                "channels": [[step.tolist() for step in row] for row in quant],
            }
            for c in carry:
                out[c] = pdf[c].astype(float).values
            yield pd.DataFrame(out)

    cols = ["series", "context", "last_date", *carry]
    return contexts.where(F.col("n") > 0).select(*cols).mapInPandas(run, schema)


def denormalize(responses: DataFrame) -> DataFrame:
    """Undo ``normalize_contexts`` on every output array: v * std + mean."""
    if "ctx_mean" not in responses.columns:
        return responses
    arrays = ["forecast", *QUANTILE_COLUMNS]
    st = F.struct(F.col("ctx_mean").alias("m"), F.col("ctx_std").alias("sd"))

    def undo(a: str):
        z = F.arrays_zip(F.col(a).alias("v"), F.array_repeat(st, F.size(a)).alias("st"))
        return F.transform(z, lambda e: e["v"] * e["st"]["sd"] + e["st"]["m"]).alias(a)

    keep = [c for c in responses.columns if c not in arrays and c not in ("ctx_mean", "ctx_std")]
    return responses.select(*keep, *[undo(a) for a in arrays])


def _picker(q: float):
    return lambda ch: pick_channel(ch, q)


def pick_quantiles(raw: DataFrame) -> DataFrame:
    """PR17 per step: choose q10..q90 from each step's channel array."""
    carry = [c for c in ("ctx_mean", "ctx_std") if c in raw.columns]
    return raw.select(
        "series_id",
        "last_date",
        "horizon",
        *carry,
        "forecast",
        *[F.transform("channels", _picker(q)).alias(c) for q, c in zip(QUANTILES, QUANTILE_COLUMNS)],
    )


def zero_shot_forecast(
    contexts: DataFrame,
    cfg: PanelConfig,
    predictor: str | Factory = "seasonal_naive",
    model: str | None = None,
    normalize: bool = False,
    fix_crossing: bool = True,
) -> DataFrame:
    """FC3 (normalise) -> FC1 -> PR17 -> FC3 (denormalise) -> PR18 -> FC3
    (crossing repair): the standard long frame from the batched slot."""
    ctx = normalize_contexts(contexts) if normalize else contexts
    raw = forecast_contexts(ctx, cfg.horizon, predictor)
    picked = pick_quantiles(raw)
    if normalize:
        picked = denormalize(picked)
    out = expand_horizon(picked, model or (predictor if isinstance(predictor, str) else "predictor"))
    return fix_quantile_crossing(out) if fix_crossing else out
