"""DuckDB twin of the regression with AR errors: the normal equations by elimination, one CTE a pivot, and the error and psi
recursions as a recursive CTE. Text is made from the number of regressors and lags."""

from __future__ import annotations

import re

from ..config import QUANTILE_COLUMNS, QUANTILES
from ..functions.scalar import Z_SCORES


def elimination(name: str, src: str, keys: str, entry, k: int) -> str:
    """CTEs ``name``_0 .. ``name``_k from ``src``: Gauss-Jordan on a k x (k + 1) system whose entries ``entry(i, j)`` are given as
    SQL (column k is the right side); the solution is s0 .. s(k-1) of ``name``."""
    cells = [(i, j) for i in range(k) for j in range(k + 1)]
    ctes = [f"  {name}_0 AS (SELECT {keys}, " + ", ".join(f"{entry(i, j)} AS m{i}_{j}" for i, j in cells) + f" FROM {src})"]
    for c in range(k):
        scaled = [f"CASE WHEN m{c}_{c} = 0 THEN 0.0 ELSE m{c}_{j} / m{c}_{c} END" for j in range(k + 1)]
        rows = [f"{scaled[j]} AS m{i}_{j}" if i == c else f"m{i}_{j} - m{i}_{c} * ({scaled[j]}) AS m{i}_{j}" for i, j in cells]
        ctes.append(f"  {name}_{c + 1} AS (SELECT {keys}, " + ", ".join(rows) + f" FROM {name}_{c})")
    ctes.append(f"  {name} AS (SELECT {keys}, " + ", ".join(f"m{i}_{k} AS s{i}" for i in range(k)) + f" FROM {name}_{k})")
    return ",\n".join(ctes)


def upper(i: int, j: int) -> str:
    return f"g{min(i, j)}_{max(i, j)}"


def xreg_ctes(name: str, regressors: list[str], holiday: str, horizon: int, ridge: float, max_p: int, model: str) -> str:
    """Predictions of the model as CTE ``name`` (PRED_COLS), from ``train``, ``infer`` and ``prepped``. ``holiday`` is the flag as SQL
    over ``date``."""
    cols = [*regressors, "hol"]
    k, lags = len(cols) + 1, range(1, max_p + 1)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    filled = ["1.0 AS x0"] + [f"COALESCE({c}, AVG({c}) OVER (PARTITION BY series), 0.0) AS x{i + 1}" for i, c in enumerate(cols)]
    trace = " + ".join(f"g{i}_{i}" for i in range(k))

    def entry(i: int, j: int) -> str:
        if j == k:
            return f"b{i}"
        return upper(i, j) + (f" + {ridge} * GREATEST(({trace}) / {k}, 1.0)" if i == j and i > 0 else "")

    fitted = " + ".join(f"s{i} * x{i}" for i in range(k))
    lag_pairs = [(i, j) for i in lags for j in lags if i <= j]
    whole = f"l{max_p} IS NOT NULL"
    parts = [
        f"""  xr AS (SELECT series, date, CAST(target AS DOUBLE) AS y, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in regressors)},
         CAST({holiday} AS DOUBLE) AS hol FROM train WHERE target IS NOT NULL)""",
        f"  xf AS (SELECT series, date, y, {', '.join(filled)} FROM xr)",
        "  xmu AS (SELECT series, " + ", ".join(f"COALESCE(AVG({c}), 0.0) AS mu{i + 1}" for i, c in enumerate(cols)) + " FROM xr GROUP BY series)",
        "  xg AS (SELECT series, COUNT(*) AS n, MAX(date) AS last_date, "
        + ", ".join([f"SUM(x{i} * x{j}) AS g{i}_{j}" for i, j in pairs] + [f"SUM(x{i} * y) AS b{i}" for i in range(k)])
        + " FROM xf GROUP BY series)",
        elimination("xe", "xg", "series, n, last_date, g0_0, b0", entry, k),
        "  xb AS (SELECT series, last_date, " + ", ".join(
            f"CASE WHEN n >= {k} THEN s{i} ELSE {'b0 / g0_0' if i == 0 else '0.0'} END AS s{i}" for i in range(k)
        ) + f" FROM (SELECT series, n, last_date, m0_{k} AS s0, " + ", ".join(f"m{i}_{k} AS s{i}" for i in range(1, k)) + f" , g0_0, b0 FROM xe_{k}))",
        f"  xres AS (SELECT series, date, y - ({fitted}) AS r FROM xf JOIN xb USING (series))",
        "  xl AS (SELECT series, date, r, " + ", ".join(f"LAG(r, {i}) OVER (PARTITION BY series ORDER BY date) AS l{i}" for i in lags) + " FROM xres)",
        "  xa AS (SELECT series, " + ", ".join(
            [f"SUM(l{i} * l{j}) FILTER ({whole}) AS g{i - 1}_{j - 1}" for i, j in lag_pairs]
            + [f"SUM(l{i} * r) FILTER ({whole}) AS b{i - 1}" for i in lags]
            + [f"SUM(r * r) FILTER ({whole}) AS rr", f"COUNT(*) FILTER ({whole}) AS m", "SUM(r * r) AS ss", "COUNT(*) AS nr"]
            + ["arg_max(r, date) AS t1"] + [f"arg_max(COALESCE(l{i}, 0.0), date) AS t{i + 1}" for i in range(1, max_p)]
        ) + " FROM xl GROUP BY series)",
    ]
    choices = [f"SELECT series, 0 AS p, {', '.join(f'CAST(0.0 AS DOUBLE) AS f{i}' for i in lags)}, rr AS sse, m * LN(GREATEST(rr, 1e-12) / m) AS aic FROM xa WHERE m > 0"]
    for p in lags:
        mean = "(" + " + ".join(f"g{i}_{i}" for i in range(p)) + f") / {p}"

        def lag_entry(i: int, j: int, p: int = p, mean: str = mean) -> str:
            return f"b{i}" if j == p else upper(i, j) + (f" + 1e-9 * GREATEST({mean}, 1.0)" if i == j else "")

        kept = "series, rr, m, " + ", ".join(f"b{i}" for i in range(p))
        parts.append(elimination(f"xp{p}", f"(SELECT * FROM xa WHERE m - 2 >= {p})", kept, lag_entry, p))
        solved = ", ".join(f"m{i}_{p} AS f{i + 1}" for i in range(p)) + "".join(f", 0.0 AS f{i}" for i in range(p + 1, max_p + 1))
        sse = "rr - (" + " + ".join(f"m{i}_{p} * b{i}" for i in range(p)) + ")"
        choices.append(
            f"SELECT series, {p}, {', '.join(f'f{i}' for i in lags)}, sse, m * LN(sse / m) + 2 * {p} "
            f"FROM (SELECT series, m, {solved}, {sse} AS sse FROM xp{p}_{p}) WHERE isfinite(sse) AND sse > 0"
        )
    shifted = lambda v: ", ".join(f"{v}{i - 1} AS {v}{i}" for i in lags if i > 1)
    step = lambda v: " + ".join(f"f{i} * {v}{i}" for i in lags)
    day = lambda c: {"day_of_week": "dayofweek(date) + 1", "month": "month(date)", "is_weekend": "CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END"}.get(c)
    free = [c for c in regressors if day(c) is None]
    known = [f"CAST({day(c)} AS DOUBLE) AS {c}" if day(c) else f"COALESCE(i.{c}, w.{c}) AS {c}" for c in regressors]
    future = ["1.0"] + [f"COALESCE({c}, mu{i + 1})" for i, c in enumerate(cols)]
    parts += [
        "  xc AS (" + "\n    UNION ALL ".join(choices) + ")",
        "  xo AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY aic, p) AS rn FROM xc)",
        f"""  xs AS (SELECT a.series, {", ".join(f"COALESCE(f{i}, 0.0) AS f{i}" for i in lags)}, {", ".join(f"t{i}" for i in lags)},
         COALESCE(CASE WHEN a.m > 0 THEN SQRT(sse / a.m) ELSE SQRT(a.ss / a.nr) END, 0.0) AS sigma
    FROM xa a LEFT JOIN (SELECT * FROM xo WHERE rn = 1) o USING (series))""",
        f"""  xpath AS (
    SELECT series, 0 AS h, {", ".join(f"f{i}" for i in lags)}, sigma, {", ".join(f"t{i} AS e{i}" for i in lags)},
           CAST(1.0 AS DOUBLE) AS p1, {", ".join(f"CAST(0.0 AS DOUBLE) AS p{i}" for i in lags if i > 1)}, CAST(0.0 AS DOUBLE) AS cum FROM xs
    UNION ALL
    SELECT series, h + 1, {", ".join(f"f{i}" for i in lags)}, sigma, {step("e")} AS e1, {shifted("e")},
           CASE WHEN h = 0 THEN 1.0 ELSE {step("p")} END AS p1,
           {", ".join(f"CASE WHEN h = 0 THEN 0.0 ELSE p{i - 1} END AS p{i}" for i in lags if i > 1)},
           cum + (CASE WHEN h = 0 THEN 1.0 ELSE {step("p")} END) * (CASE WHEN h = 0 THEN 1.0 ELSE {step("p")} END)
    FROM xpath WHERE h < {horizon})""",
        "  xw AS (SELECT date, " + (", ".join(f"MAX(CAST({c} AS DOUBLE)) AS {c}" for c in free) or "1") + " FROM infer GROUP BY date)",
        f"""  xday AS (SELECT b.series, CAST(b.last_date + CAST(p.h AS INTEGER) AS DATE) AS date, CAST(p.h AS INTEGER) AS horizon_step, p.e1 AS e,
         p.sigma * SQRT(p.cum) AS se FROM xb b JOIN xpath p USING (series) WHERE p.h > 0)""",
        f"""  xk AS (SELECT series, date, horizon_step, e, se, {", ".join(known)}, CAST({holiday} AS DOUBLE) AS hol
    FROM xday LEFT JOIN (SELECT series, date, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in free)} FROM infer) i USING (series, date)
    LEFT JOIN xw w USING (date))""",
        f"""  xv AS (SELECT series, date, horizon_step, se, e + {" + ".join(f"s{i} * ({x})" for i, x in enumerate(future))} AS forecast
    FROM xk JOIN xb USING (series) JOIN xmu USING (series))""",
        f"  {name} AS (SELECT series, date, horizon_step, forecast, "
        + ", ".join(f"forecast + {Z_SCORES[q]} * se AS {c}" for q, c in zip(QUANTILES, QUANTILE_COLUMNS, strict=True))
        + f", '{model}' AS model FROM xv)",
    ]
    return ",\n".join(parts)


_CTE = re.compile(r"\b(xr|xf|xmu|xg|xe(?:_\d+)?|xb|xres|xl|xa|xp\d+(?:_\d+)?|xc|xo|xs|xpath|xw|xday|xk|xv|train|infer)\b")


def renamed(ctes: str, prefix: str) -> str:
    """The same CTEs under another prefix, over ``<prefix>train`` and ``<prefix>infer``: a variant's own."""
    return _CTE.sub(lambda m: prefix + m[1], ctes)


def stationarity_sql(bandwidth: int = 12, point: float = 0.463, seasonal: float = 0.4, week: int = 7) -> str:
    """KPSS statistic and share of the variance between weekdays, over deviations from the mean in ``train``."""
    lags = range(1, bandwidth + 1)
    width = f"LEAST(FLOOR(4 * POW(n / 100.0, 0.25)), {bandwidth})"
    long_run = "(g0 + " + " + ".join(f"CASE WHEN {k - 1} < {width} THEN 2 * (1 - {k} / ({width} + 1)) * COALESCE(g{k}, 0.0) ELSE 0.0 END" for k in lags) + ") / n"

    def strength(v: str) -> str:
        return f"CASE WHEN SUM(q{v}) - SUM(s{v}) * SUM(s{v}) / SUM(c{v}) > 1e-9 THEN (SUM(s{v} * s{v} / NULLIF(c{v}, 0)) - SUM(s{v}) * SUM(s{v}) / SUM(c{v})) / (SUM(q{v}) - SUM(s{v}) * SUM(s{v}) / SUM(c{v})) ELSE 0.0 END"

    return f"""
SELECT series, n, ROUND(kpss, 6) AS kpss, d, ROUND(strength, 6) AS strength,
       CAST(CASE WHEN strength > {seasonal} AND n >= {6 * week} THEN 1 ELSE 0 END AS INTEGER) AS seasonal FROM (
  SELECT k.series, k.n, k.kpss, CAST(CASE WHEN k.kpss > {point} THEN 1 ELSE 0 END AS INTEGER) AS d,
         CASE WHEN k.kpss > {point} THEN b.by_dr ELSE b.by_r END AS strength
  FROM (
    SELECT series, n, CASE WHEN {long_run} > 1e-9 THEN ss / (CAST(n AS DOUBLE) * n) / ({long_run}) ELSE 0.0 END AS kpss FROM (
      SELECT series, CAST(COUNT(*) AS BIGINT) AS n, SUM(s * s) AS ss, SUM(r * r) AS g0, {", ".join(f"SUM(r * r{k}) AS g{k}" for k in lags)} FROM (
        SELECT series, r, SUM(r) OVER (PARTITION BY series ORDER BY date) AS s, {", ".join(f"LAG(r, {k}) OVER (PARTITION BY series ORDER BY date) AS r{k}" for k in lags)}
        FROM (SELECT series, date, CAST(target AS DOUBLE) - AVG(CAST(target AS DOUBLE)) OVER (PARTITION BY series) AS r FROM train)) GROUP BY series)) k
  JOIN (
    SELECT series, {strength("r")} AS by_r, {strength("dr")} AS by_dr FROM (
      SELECT series, dow, SUM(r) AS sr, SUM(r * r) AS qr, COUNT(r) AS cr, SUM(dr) AS sdr, SUM(dr * dr) AS qdr, COUNT(dr) AS cdr FROM (
        SELECT series, dayofweek(date) AS dow, r, r - LAG(r) OVER (PARTITION BY series ORDER BY date) AS dr
        FROM (SELECT series, date, CAST(target AS DOUBLE) - AVG(CAST(target AS DOUBLE)) OVER (PARTITION BY series) AS r FROM train)) GROUP BY series, dow)
    GROUP BY series) b USING (series))"""
