"""DuckDB CTE fragments for contexts, the seasonal-naive forecaster, the scorer
and the ranking. They build on the ``prepped`` CTE of ``oracle_sql``."""

from __future__ import annotations

from ..config import QUANTILE_COLUMNS, QUANTILES


def contexts_cte(name: str = "ctx", context_len: int = 512) -> str:
    return f"""
  {name} AS (
    SELECT series, list(y ORDER BY date) AS context, MAX(date) AS last_date, COUNT(*) AS n
    FROM (SELECT series, date, CAST(target AS DOUBLE) AS y,
                 ROW_NUMBER() OVER (PARTITION BY series ORDER BY date DESC) AS rn
          FROM prepped WHERE splits <> 'TEST') WHERE rn <= {context_len} GROUP BY series)"""


def naive_cte(name: str, horizon: int, period: int, model: str, ctx: str = "ctx", keys: str = "",
              horizon_col: str | None = None) -> str:
    """Long predictions of the seasonal naive (period p) as CTE ``name``.

    ``keys`` (e.g. ``"variant, "``) are carried through; ``horizon_col`` caps
    the steps per row (``horizon`` is then the largest value)."""
    spreads = ", ".join(f"quantile_cont(d, {q}) AS s{i}" for i, q in enumerate(QUANTILES))
    fc_spreads = ", ".join(
        f"CASE WHEN s.n >= s.lag THEN COALESCE(sp.s{i}, 0.0) ELSE 0.0 END AS sp{i}" for i in range(len(QUANTILES))
    )
    qcols = ", ".join(f"forecast + sp{i} AS {c}" for i, c in enumerate(QUANTILE_COLUMNS))
    key_list = [k.strip() for k in keys.split(",") if k.strip()]
    skeys = "".join(f"s.{k}, " for k in key_list)
    join_keys = "".join(f" AND s.{k} = sp.{k}" for k in key_list)
    akeys = "".join(f"a.{k}, " for k in key_list)
    ab_keys = "".join(f" AND a.{k} = b.{k}" for k in key_list)
    v_keys = "".join(f" AND s.{k} = v.{k}" for k in key_list)
    cap = f" AND h <= {horizon_col}" if horizon_col else ""
    return f"""
  {name}_lags AS (
    SELECT h, CAST(ceil(h / {period}.0) * {period} AS BIGINT) AS lag FROM (SELECT UNNEST(range(1, {horizon} + 1)) AS h)),
  {name}_vals AS (SELECT {keys}series, UNNEST(context) AS v, UNNEST(range(1, n + 1)) AS t FROM {ctx} WHERE n > 0),
  {name}_diffs AS (
    SELECT {akeys}a.series, l.lag, a.v - b.v AS d
    FROM {name}_vals a, (SELECT DISTINCT lag FROM {name}_lags) l JOIN {name}_vals b
      ON a.series = b.series AND b.t = a.t - l.lag{ab_keys}),
  {name}_spread AS (SELECT {keys}series, lag, {spreads} FROM {name}_diffs GROUP BY {keys}series, lag),
  {name}_steps AS (
    SELECT {keys}series, n, last_date, h, lag, CASE WHEN n >= lag THEN n - lag + h ELSE n END AS t
    FROM {ctx}, {name}_lags WHERE n > 0{cap}),
  {name}_fc AS (
    SELECT {skeys}s.series, CAST(s.last_date + CAST(s.h AS INTEGER) AS DATE) AS date, CAST(s.h AS INTEGER) AS horizon_step,
           v.v AS forecast, {fc_spreads}
    FROM {name}_steps s JOIN {name}_vals v ON s.series = v.series AND s.t = v.t{v_keys}
    LEFT JOIN {name}_spread sp ON s.series = sp.series AND s.lag = sp.lag{join_keys}),
  {name} AS (SELECT {keys}series, date, horizon_step, forecast, {qcols}, '{model}' AS model FROM {name}_fc)"""


PRED_COLS = "series, date, horizon_step, forecast, " + ", ".join(QUANTILE_COLUMNS) + ", model"


def rounded_pred_select(src: str) -> str:
    qs = ", ".join(f"ROUND({c}, 6) AS {c}" for c in QUANTILE_COLUMNS)
    return f"SELECT series, date, horizon_step, ROUND(forecast, 6) AS forecast, {qs}, model FROM {src}"


ACTUALS_CTE = """
  actual AS (SELECT series, date, CAST(target AS DOUBLE) AS actual FROM prepped WHERE splits = 'TEST')"""


def metric_exprs() -> str:
    pin = " + ".join(
        f"GREATEST({q} * (actual - {c}), ({q} - 1.0) * (actual - {c}))" for q, c in zip(QUANTILES, QUANTILE_COLUMNS)
    )
    return f"""AVG(ABS(forecast - actual)) AS mae,
           SQRT(AVG((forecast - actual) * (forecast - actual))) AS rmse,
           AVG(CASE WHEN (ABS(actual) + ABS(forecast)) / 2.0 = 0 THEN 0.0
                    ELSE ABS(forecast - actual) / ((ABS(actual) + ABS(forecast)) / 2.0) END) * 100.0 AS smape,
           AVG(({pin}) / {float(len(QUANTILES))}) AS quantile_loss,
           CAST(COUNT(*) AS BIGINT) AS n_points"""


def metrics_cte(name: str, preds: str, by: str = "model") -> str:
    return f"""
  {name} AS (
    SELECT {by}, {metric_exprs()}
    FROM {preds} p JOIN actual a USING (series, date) GROUP BY {by})"""


def rank_cte(name: str, metrics: str, partition: str = "") -> str:
    def fin(c: str) -> str:
        return f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN CAST('inf' AS DOUBLE) ELSE {c} END"

    part = f"PARTITION BY {partition} " if partition else ""
    return f"""
  {name} AS (
    SELECT *, CAST(ROW_NUMBER() OVER ({part}ORDER BY {fin('rmse')}, {fin('mae')}, model) AS INTEGER) AS rank
    FROM {metrics})"""
