"""EX3 for the fitted regression: every variant's model from one plan.

Variants differ in the day their training ends. Missing values take the training mean, which moves with that day, so the Gram sums
are kept over [1, known values, missing flags]: from these every imputed Gram is arithmetic. They are summed between consecutive
cut days, one row per series and interval, and cumulated by series: a cut day is a look-up. Errors and their lag Gram follow per
(series, cut), where the rows of a series already lie; forecasts are then fanned out to the variants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PanelConfig
from .forecast import xreg as X
from .forecast.future import CALENDAR
from .forecast.holidays import holiday_flag
from .frames import from_point_stderr
from .sweep import _variant_array

FIT = "series string, cut date, last_date date, n long, mu array<double>, beta array<double>"


def imputed_gram(g: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, Gram, right side) of [1, x1 .. xk] whose missing values are the means, from the sums over [1, z, u]: z the values
    (0 where missing), u the missing flags."""
    n = g[0, 0]
    known = n - g[0, 1 + k :]
    mu = np.where(known > 0, g[0, 1 : 1 + k] / np.maximum(known, 1), 0.0)
    t = np.zeros((1 + k, 1 + 2 * k))  # x = t [1, z, u]
    t[0, 0] = 1
    for i in range(k):
        t[1 + i, 1 + i], t[1 + i, 1 + k + i] = 1, mu[i]
    return mu, t @ g @ t.T, t @ b


def _fits(cuts: list, k: int, ridge: float):
    """Per series one row a cut day that has training rows: its cumulated sums, solved."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for series, parts in zip(pdf["series"], pdf["parts"], strict=True):
                g, b, n, last = np.zeros((1 + 2 * k, 1 + 2 * k)), np.zeros(1 + 2 * k), 0, None
                by_interval = {p["interval"]: p for p in parts}
                for i, cut in enumerate(cuts):
                    if (p := by_interval.get(i)) is not None:
                        g, b = g + X._unpack(np.asarray(p["g"], float), 1 + 2 * k), b + np.asarray(p["b"], float)
                        n, last = n + int(p["n"]), p["last"]
                    if n:
                        mu, gram, right = imputed_gram(g, b, k)
                        out.append((series, cut, last, n, mu.tolist(), X._ridge_solve(gram, right, n, ridge).tolist()))
            yield pd.DataFrame(out, columns=["series", "cut", "last_date", "n", "mu", "beta"])

    return run


def fit_cuts(panel: DataFrame, cuts: list, cfg: PanelConfig, regressors=None, ridge: float = X.RIDGE, max_p: int = X.MAX_P) -> DataFrame:
    """The model of ``xreg.fit_xreg`` for every (series, cut): trained on the days up to ``cut``."""
    from ..sources.tables import materialize

    cuts = sorted(set(cuts))
    regs = X._regressors(cfg, regressors)
    cols = [*regs, "_holiday"]
    k = len(cols)
    base = X._feature_frame(panel, cfg, regs).where(F.col("y").isNotNull() & (F.col("date") <= F.lit(cuts[-1])))
    interval = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("date")))
    z = [F.coalesce(F.col(c), F.lit(0.0)) for c in cols]
    u = [F.col(c).isNull().cast("double") for c in cols]
    rows = base.withColumn("v", F.array(F.lit(1.0), *z, *u)).withColumn("interval", interval)
    sums = rows.groupBy("series", "interval").agg(*X._gram_aggs("v", "y", 1 + 2 * k, "s"), F.max("date").alias("last"))
    part = F.struct("interval", F.col("s_g").alias("g"), F.col("s_b").alias("b"), F.col("s_n").alias("n"), "last")
    fits = sums.groupBy("series").agg(F.collect_list(part).alias("parts"))  # at most a row per cut day
    models = materialize(fits.mapInPandas(_fits(cuts, k, ridge), FIT), "sweep-fits")
    feats = base.join(models.select("series", "cut", "mu", "beta"), "series").where(F.col("date") <= F.col("cut"))
    res = feats.withColumn("r", F.col("y") - X._dot(X._x(cols), F.col("beta")))
    return models.join(X.error_model(res, max_p, ("cut",)), ["series", "cut"])


def sweep_xreg(panel: DataFrame, ranks: DataFrame, variants: list, cfg: PanelConfig, model_name: str = "xreg", regressors=None) -> DataFrame:
    """Long predictions of every variant: ``panel`` has the series, days, target and covariates of the largest variant, ``ranks`` the
    series with ``volume_rank``, ``variants`` are those of ``sweep.sweep_panel``."""
    s, t = cfg.series_column, cfg.time_column
    regs = X._regressors(cfg, regressors)
    model = fit_cuts(panel, [v["cut"] for v in variants], cfg, regressors)
    fan = model.join(ranks, "series").select("*", F.explode(_variant_array(variants, F.col("cut"))).alias("v"))
    longest = max(v["horizon"] for v in variants)
    paths = model.select(F.concat_ws("|", "series", "cut").alias("series"), "phi", "last_resid", "sigma").mapInPandas(X._paths(longest), X.PATH_SCHEMA)
    steps = fan.withColumn("_id", F.concat_ws("|", "series", "cut")).join(paths.withColumnRenamed("series", "_id"), "_id").select(
        "series", "cut", "mu", "beta", "e_path", "se_path", F.col("v.variant").alias("variant"), "last_date",
        F.posexplode(F.sequence(F.lit(1), F.col("v.horizon"))).alias("_i", "h"),
    ).withColumn("date", F.date_add("last_date", F.col("h")))
    # a day's covariates are known from the variant's rows after its cut: the series' own, or any of its series' of that day
    free = [c for c in regs if c not in CALENDAR]
    out = steps
    if free:
        cuts = F.array(*[F.lit(c) for c in sorted({v["cut"] for v in variants})])
        rows = panel.select(F.col(s).alias("series"), F.col(t).alias("date"), *[F.col(c).cast("double").alias(c) for c in free])
        late = rows.where(F.col("date") > F.lit(min(v["cut"] for v in variants))).join(ranks, "series")
        late = late.select("series", "date", "volume_rank", *free, F.explode(F.filter(cuts, lambda c: F.col("date") > c)).alias("cut"))
        late = late.select("series", "date", *free, F.explode(_variant_array(variants, F.col("cut"))).alias("v"))
        days = late.groupBy(F.col("v.variant").alias("variant"), "date").agg(*[F.max(c).alias(f"day_{c}") for c in free])
        own = rows.select("series", "date", *[F.col(c).alias(f"own_{c}") for c in free])
        out = out.join(own, ["series", "date"], "left").join(days, ["variant", "date"], "left")
    later = F.col("date") > F.col("cut")
    known = [
        (CALENDAR[c]("date").cast("double") if c in CALENDAR else F.coalesce(F.when(later, F.col(f"own_{c}")), F.col(f"day_{c}"))).alias(c)
        for c in regs
    ]
    out = out.select(*steps.columns, *known, holiday_flag("date", cfg.holiday_region).cast("double").alias("_holiday"))
    raw = out.select(
        F.concat_ws("|", "variant", "series").alias("_key"), "variant", "series", F.col("date").cast("timestamp_ntz").alias("forecast_timestamp"),
        (X._dot(X._x([*regs, "_holiday"]), F.col("beta")) + F.col("e_path")[F.col("_i")]).alias("forecast_value"),
        F.col("se_path")[F.col("_i")].alias("standard_error"),
    )
    long = from_point_stderr(raw, "_key", model_name)
    names = F.split("series", r"\|", 2)
    return long.withColumn("variant", names[0]).withColumn("series", names[1])
