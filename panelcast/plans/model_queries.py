"""Registered queries of the fitted models (FC4-FC9) and their mappings."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import functions as F

from ..config import QUANTILE_COLUMNS
from ..functions.scalar import Z_SCORES
from ..operators import panel as P
from ..operators import score
from ..operators.forecast import arima, baselines, holidays, xreg
from ..session import shared_path
from ..sources.scans import actuals
from . import forecast_sql as FS
from .backtest import counts_for, prepped_for
from .common import NATION, SUPPLIER, rounded
from .oracle_sql import with_panel
from .registry import register
from .xreg_sql import renamed, stationarity_sql, xreg_ctes

HOLIDAY_CASE = """CASE WHEN (month(date) = 1 AND day(date) = 1) OR (month(date) = 7 AND day(date) = 4)
  OR (month(date) = 11 AND day(date) = 11) OR (month(date) = 12 AND day(date) = 25)
  OR (month(date) = 6 AND day(date) = 19 AND year(date) >= 2021)
  OR (month(date) = 1 AND dayofweek(date) = 1 AND day(date) BETWEEN 15 AND 21)
  OR (month(date) = 2 AND dayofweek(date) = 1 AND day(date) BETWEEN 15 AND 21)
  OR (month(date) = 5 AND dayofweek(date) = 1 AND day(date) >= 25)
  OR (month(date) = 9 AND dayofweek(date) = 1 AND day(date) <= 7)
  OR (month(date) = 10 AND dayofweek(date) = 1 AND day(date) BETWEEN 8 AND 14)
  OR (month(date) = 11 AND dayofweek(date) = 4 AND day(date) BETWEEN 22 AND 28)
  THEN 1 ELSE 0 END"""
HOLIDAY_SQL = f"CAST({HOLIDAY_CASE} AS BIGINT)"
#: Of the regression's results.
XREG_DIGITS = 6


# FC9: holiday flag for every panel day (nation adapter).
@register("holiday_flags", with_panel("nation", f"SELECT DISTINCT date, {HOLIDAY_SQL} AS is_holiday FROM source"))
def q_holidays(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    return prepped.select("date").distinct().select("date", holidays.holiday_flag("date", "US").alias("is_holiday"))


# FC9: every region's flags, with the days kept for weekends; Easter by Butcher's rule in the twin.
def _region_sql() -> str:
    dow = "isodow(d)"  # Monday 1 .. Sunday 7

    def rule(r: tuple, d: str = "d") -> str:
        if r[0] == "day":
            since = f" AND year({d}) >= {r[3]}" if r[3] else ""
            return f"(month({d}) = {r[1]} AND day({d}) = {r[2]}{since})"
        if r[0] == "nth":
            week = f"day({d}) > day(last_day({d})) - 7" if r[3] < 0 else f"(day({d}) + 6) // 7 = {r[3]}"
            return f"(month({d}) = {r[1]} AND isodow({d}) = {r[2] - 1} AND {week})"
        if r[0] == "before":
            return f"(month({d}) = {r[1]} AND isodow({d}) = {r[3] - 1} AND day({d}) >= {r[2] - 7} AND day({d}) < {r[2]})"
        return f"({d} - easter = {r[1]})"

    flags = []
    for region, rules in holidays.RULES.items():
        plain = " OR ".join(rule(r) for r in rules)
        fixed = lambda k, rules=rules: "(" + " OR ".join(rule(r, f"CAST(d + {k} AS DATE)") for r in rules if r[0] == "day") + ")"
        kept = {
            "nearest": f"({dow} = 1 AND {fixed(-1)}) OR ({dow} = 5 AND {fixed(1)})",
            "next": f"({dow} = 1 AND ({fixed(-1)} OR {fixed(-2)})) OR ({dow} = 2 AND (({fixed(-2)} AND {fixed(-1)}) OR ({fixed(-3)} AND {fixed(-2)})))",
            None: "FALSE",
        }[holidays.OBSERVED.get(region)]
        flags += [f"CAST(({plain}) AS BIGINT) AS {region.lower()}", f"CAST(({plain} OR {kept}) AS BIGINT) AS {region.lower()}_kept"]
    return f"""SELECT d AS date, {", ".join(flags)} FROM (
  SELECT d, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM (
    SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM (
      SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
        SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM (
          SELECT date AS d, year(date) AS y, year(date) % 19 AS a, year(date) // 100 AS b, (year(date) // 100) % 4 AS e,
                 (year(date) % 100) // 4 AS i, year(date) % 4 AS k FROM (SELECT DISTINCT date FROM source))))))"""


@register("holiday_regions", with_panel("nation", _region_sql()))
def q_holiday_regions(spark, sf_dir):
    days = prepped_for(spark, sf_dir, "nation", NATION).select("date").distinct()
    flags = [holidays.holiday_flag("date", r, kept).alias(r.lower() + ("_kept" if kept else "")) for r in holidays.RULES for kept in (False, True)]
    return days.select("date", *flags)


# FC4 one-regressor variant: per-series OLS of the target on temp (train rows).
@register(
    "xreg_one_regressor",
    with_panel(
        "supplier",
        """SELECT series, ROUND(regr_slope(CAST(target AS DOUBLE), temp), 6) AS slope,
                  ROUND(regr_intercept(CAST(target AS DOUBLE), temp), 6) AS intercept,
                  CAST(regr_count(CAST(target AS DOUBLE), temp) AS BIGINT) AS n
           FROM train GROUP BY series""",
        SUPPLIER,
    ),
)
def q_xreg_one(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    return rounded(xreg.fit_one_regressor(P.build_train(prepped), SUPPLIER, "temp"))


# FC4 with two regressors and no holiday: the Gram solve against its closed form (means imputed on both sides).
PLAIN = NATION.replace(holiday_region=None)


@register(
    "xreg_two_regressors",
    with_panel(
        "nation",
        """SELECT series, ROUND(my - b1 * m1 - b2 * m2, 4) AS intercept, ROUND(b1, 4) AS b_temp, ROUND(b2, 4) AS b_prcp, n
           FROM (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
                        (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2
                 FROM (SELECT series, CAST(COUNT(*) AS BIGINT) AS n, AVG(y) AS my, AVG(x1) AS m1, AVG(x2) AS m2,
                              VAR_POP(x1) AS s11, VAR_POP(x2) AS s22, COVAR_POP(x1, x2) AS s12,
                              COVAR_POP(x1, y) AS s1y, COVAR_POP(x2, y) AS s2y
                       FROM (SELECT series, CAST(target AS DOUBLE) AS y,
                                    COALESCE(temp, AVG(temp) OVER (PARTITION BY series), 0.0) AS x1,
                                    COALESCE(prcp, AVG(prcp) OVER (PARTITION BY series), 0.0) AS x2 FROM train)
                       GROUP BY series))""",
        PLAIN,
    ),
)
def q_xreg_two(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", PLAIN)
    model = xreg.fit_xreg(P.build_train(prepped), PLAIN, regressors=["temp", "prcp"], ridge=0.0)
    b = F.col("beta")
    return model.select(
        "series", F.round(b[0], 4).alias("intercept"), F.round(b[1], 4).alias("b_temp"), F.round(b[2], 4).alias("b_prcp"), "n"
    )


def _z(c: str) -> float:
    return Z_SCORES[{"q10": 0.1, "q30": 0.3, "q50": 0.5, "q70": 0.7, "q90": 0.9}[c]]


_MEAN_SQL = with_panel(
    "supplier",
    "SELECT series, date, horizon_step, ROUND(v, 6) AS forecast, "
    + ", ".join(f"ROUND(v + {_z(c)} * se, 6) AS {c}" for c in QUANTILE_COLUMNS)
    + ", 'train_mean' AS model FROM ("
    "SELECT s.series, CAST(s.last_date + CAST(h AS INTEGER) AS DATE) AS date, CAST(h AS INTEGER) AS horizon_step, s.v, s.se "
    "FROM (SELECT series, AVG(CAST(target AS DOUBLE)) AS v, STDDEV_POP(CAST(target AS DOUBLE)) AS se, MAX(date) AS last_date "
    "      FROM prepped WHERE splits <> 'TEST' GROUP BY series) s, "
    f"(SELECT UNNEST(range(1, {SUPPLIER.horizon} + 1)) AS h))",
    SUPPLIER,
)


# PR14 + PR15 + WN2: point + standard error -> Gaussian quantiles, step rank.
@register("gaussian_quantiles", _MEAN_SQL)
def q_gaussian(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    return rounded(baselines.mean_forecast(prepped, SUPPLIER))


# FC4 + FC5 + FC8 + JN10: regression with AR errors, fitted, written, read back by
# reference and forecast over the TEST window.
XREG_SQL = xreg_ctes("xfc", list(NATION.roles.available), HOLIDAY_CASE, NATION.horizon, xreg.RIDGE, xreg.MAX_P, "xreg")
MEAN_CTE = "mfc AS (SELECT series, CAST(last_date + CAST(h AS INTEGER) AS DATE) AS date, CAST(h AS INTEGER) AS horizon_step, v AS forecast, " + ", ".join(
    f"v + {_z(c)} * se AS {c}" for c in QUANTILE_COLUMNS
) + (
    ", 'train_mean' AS model FROM (SELECT series, AVG(CAST(target AS DOUBLE)) AS v, STDDEV_POP(CAST(target AS DOUBLE)) AS se, MAX(date) AS last_date "
    f"FROM train GROUP BY series), (SELECT UNNEST(range(1, {NATION.horizon} + 1)) AS h))"
)


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _rounded_sql(columns, digits: int) -> str:
    return ", ".join(f"ROUND({c}, {digits}) AS {c}" for c in columns)


@register(
    "xreg_forecast",
    _recursive(
        with_panel(
            "nation", f"SELECT series, date, horizon_step, {_rounded_sql(['forecast', *QUANTILE_COLUMNS], XREG_DIGITS)}, model FROM xfc", NATION, extra=XREG_SQL
        )
    ),
)
def q_xreg_forecast(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    path = shared_path(spark, "models", f"xreg-{uuid.uuid4().hex[:12]}")
    xreg.fit_xreg(P.build_train(prepped), NATION, model_path=path)
    model = xreg.load_xreg(spark, path)  # by reference
    return rounded(xreg.forecast_xreg(model, P.build_infer(prepped, NATION), NATION, "xreg"), XREG_DIGITS)


# FC5 scored: xreg vs the train-mean baseline with the shared scorer.
@register(
    "xreg_scores",
    _recursive(
        with_panel(
            "nation",
            f"SELECT model, {_rounded_sql(['mae', 'rmse', 'smape', 'quantile_loss'], XREG_DIGITS)}, n_points FROM m",
            NATION,
            extra=XREG_SQL + f",\n{MEAN_CTE},\n  preds AS (SELECT {FS.PRED_COLS} FROM xfc UNION ALL SELECT {FS.PRED_COLS} FROM mfc),"
            + FS.ACTUALS_CTE + "," + FS.metrics_cte("m", "preds"),
        )
    ),
)
def q_xreg_scores(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    model = xreg.fit_xreg(P.build_train(prepped), NATION)
    fc = xreg.forecast_xreg(model, P.build_infer(prepped, NATION), NATION, "xreg")
    base = baselines.mean_forecast(prepped, NATION)
    return rounded(score.evaluate(fc.unionByName(base), actuals(prepped, NATION)), XREG_DIGITS)



# EX3 for a fitted model: the regression of every variant (other held-out lengths, horizons and numbers of series) in one plan.
FIT_AXES = {"data.station_filter.top_n": [5, 25], "data.splits.test_length": [7, 14], "forecast.horizon": [7]}


def _fit_sweep_sql() -> str:
    ctes, preds, acts = ["ranks AS (SELECT series, ROW_NUMBER() OVER (ORDER BY n_rows DESC, series ASC) AS volume_rank FROM top)"], [], []
    for i, (top_n, test, horizon) in enumerate(itertools.product(*FIT_AXES.values())):
        name, p = f"top_n{top_n}-test_length{test}-horizon{horizon}", f"v{i}_"
        own = f"(SELECT s.* FROM source s JOIN ranks r USING (series) WHERE r.volume_rank <= {top_n})"
        cut = f"(SELECT MAX(date) - {test} FROM {own})"
        ctes.append(f"  {p}train AS (SELECT * FROM {own} WHERE date <= {cut})")
        ctes.append(f"  {p}infer AS (SELECT * FROM {own} WHERE date > {cut})")
        ctes.append(renamed(xreg_ctes(f"{p}fc", list(NATION.roles.available), HOLIDAY_CASE, horizon, xreg.RIDGE, xreg.MAX_P, "xreg"), p))
        preds.append(f"SELECT '{name}' AS variant, {FS.PRED_COLS} FROM {p}fc")
        acts.append(f"SELECT '{name}' AS variant, series, date, CAST(target AS DOUBLE) AS actual FROM {p}infer")
    ctes += ["  vp AS (" + " UNION ALL ".join(preds) + ")", "  va AS (" + " UNION ALL ".join(acts) + ")"]
    body = f"SELECT variant, model, {_rounded_sql(['mae', 'rmse', 'smape', 'quantile_loss'], XREG_DIGITS)}, n_points FROM (SELECT variant, model, {FS.metric_exprs()} FROM vp JOIN va USING (variant, series, date) GROUP BY variant, model)"
    return _recursive(with_panel("nation", body, NATION, extra=",\n".join(ctes)))


@register("sweep_fitted_scores", _fit_sweep_sql())
def q_sweep_fitted(spark, sf_dir):
    from ..operators import sweep, sweep_fit
    from ..sources import adapters

    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    grid = sweep.doe_grid(spark, FIT_AXES, NATION)
    rows, variants = sweep.sweep_panel(adapters.nation_trips(spark, sf_dir), prepped, grid, NATION, counts_for(spark, sf_dir, "nation"))
    ranks = rows.groupBy("series").agg(F.max("volume_rank").alias("volume_rank"))
    preds = sweep_fit.sweep_xreg(prepped, ranks, variants, NATION)
    scores = score.evaluate_checked(preds, sweep.sweep_actuals(rows, variants), ("variant", "model"))
    return rounded(scores, XREG_DIGITS)


# FC4: the order of differencing of each series' regression errors (here of the target's deviations from its mean).
@register(
    "arima_stationarity",
    with_panel("nation", stationarity_sql(), NATION),
)
def q_stationarity(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    train = P.build_train(prepped).select(F.col("series"), F.col("date"), F.col("target").cast("double").alias("y"))
    mean = train.groupBy("series").agg(F.avg("y").alias("m"))
    return rounded(arima.stationarity(train.join(mean, "series").select("series", "date", (F.col("y") - F.col("m")).alias("r"))))


# FC4 + FC5: differences, weekly and moving-average terms, against the AR errors and the mean (numpy brute force in the tests).
@register("arima_scores")
def q_arima(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    train, infer = P.build_train(prepped), P.build_infer(prepped, SUPPLIER)
    path = shared_path(spark, "models", f"arima-{uuid.uuid4().hex[:12]}")
    fc = arima.forecast_arima(arima.fit_arima(train, SUPPLIER, model_path=path), infer, SUPPLIER)
    other = xreg.forecast_xreg(xreg.fit_xreg(train, SUPPLIER), infer, SUPPLIER, "xreg")
    preds = fc.unionByName(other).unionByName(baselines.mean_forecast(prepped, SUPPLIER))
    return rounded(score.evaluate_checked(preds, actuals(prepped, SUPPLIER)))



# FC6 + FC7 + FC8: global gradient-boosted model (direct multi-step), saved and
# re-loaded by path, nested output flattened by level (numpy brute force in the tests).
@register("global_forecast")
def q_global(spark, sf_dir):
    from ..operators.forecast import global_gbt

    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    path = shared_path(spark, "models", f"global-gbt-{uuid.uuid4().hex[:12]}")
    fitted = global_gbt.fit_global(prepped, NATION, path)
    reference = fitted.path
    del fitted  # forecast from the stored model alone
    model = global_gbt.GlobalModel.load(spark, reference)
    return rounded(global_gbt.forecast_global(model, prepped, NATION))
