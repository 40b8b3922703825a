"""Registered queries of the forecast, scoring and ranking layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import QUANTILE_COLUMNS, QUANTILES
from ..operators import compare, contexts, score
from ..operators.forecast import zero_shot
from ..operators.frames import flatten_nested, horizon_rank, union_predictions
from ..sources.scans import actuals
from . import forecast_sql as FS
from .backtest import counts_for, prepped_for, zero_shot_predictions
from .common import NATION, SUPPLIER, USER, rounded
from .oracle_sql import with_panel
from .registry import register


def _naive_sql(adapter, cfg, body, period=7, model="seasonal_naive"):
    extra = FS.contexts_cte("ctx", cfg.context_len) + "," + FS.naive_cte("fc", cfg.horizon, period, model)
    return with_panel(adapter, body, cfg, extra=extra)


def _two_model_ctes(cfg, horizon_b=None):
    hb = horizon_b or cfg.horizon
    return (
        FS.contexts_cte("ctx", cfg.context_len)
        + ","
        + FS.naive_cte("fa", cfg.horizon, 7, "seasonal_naive")
        + ","
        + FS.naive_cte("fb", hb, 1, "last_value")
        + f""",
  preds AS (SELECT {FS.PRED_COLS} FROM fa UNION ALL SELECT {FS.PRED_COLS} FROM fb),"""
        + FS.ACTUALS_CTE
    )


# WN3: contexts, long form (series, pos, value, last_date); every supplier.
@register(
    "series_contexts",
    with_panel(
        "supplier",
        "SELECT series, CAST(pos AS INTEGER) AS pos, ROUND(value, 6) AS value, last_date "
        "FROM (SELECT series, last_date, UNNEST(context) AS value, UNNEST(range(1, len(context) + 1)) AS pos FROM ctx)",
        SUPPLIER,
        extra=FS.contexts_cte("ctx", SUPPLIER.context_len),
    ),
)
def q_contexts(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    long = contexts.contexts_long(contexts.series_contexts(prepped, SUPPLIER))
    return rounded(long.withColumn("pos", F.col("pos").cast("int")))


# FC2: weekly seasonal naive, every supplier (staggered ends included).
@register("seasonal_naive_long", _naive_sql("supplier", SUPPLIER, FS.rounded_pred_select("fc")))
def q_seasonal_naive(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    ctx = contexts.series_contexts(prepped, SUPPLIER)
    return rounded(zero_shot.seasonal_naive(ctx, SUPPLIER.horizon, 7, "seasonal_naive"))


# FC2 with period 1 (last value) on the short-history user adapter.
@register("last_value_long", _naive_sql("user", USER, FS.rounded_pred_select("fc"), period=1, model="last_value"))
def q_last_value(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "user", USER)
    ctx = contexts.series_contexts(prepped, USER)
    return rounded(zero_shot.seasonal_naive(ctx, USER.horizon, 1, "last_value"))


# FC3 + FC1 + PR17 + PR18: batched slot (mapInPandas) with the default
# predictor on normalised contexts, outputs de-normalised, ten-channel head ->
# q10..q90 by channel, crossing repaired; the weekly naive is equivariant under
# normalisation, so this equals FC2 and its DuckDB twin.
@register("forecast_contexts", _naive_sql("nation", NATION, FS.rounded_pred_select("fc")))
def q_forecast_contexts(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    ctx = contexts.series_contexts(prepped, NATION)
    out = zero_shot.zero_shot_forecast(ctx, NATION, "seasonal_naive", model="seasonal_naive", normalize=True)
    return rounded(out)


# PR16: nested model output (levels out of order) flattened by level.
@register("struct_flatten", _naive_sql("nation", NATION, FS.rounded_pred_select("fc")))
def q_struct_flatten(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    fc = zero_shot.seasonal_naive(contexts.series_contexts(prepped, NATION), NATION.horizon, 7, "seasonal_naive")
    order = [0.5, 0.1, 0.9, 0.3, 0.7]
    nested = fc.select(
        "series",
        "date",
        F.struct(
            F.col("forecast").alias("value"),
            F.array(*[F.lit(q) for q in order]).alias("quantile_values"),
            F.array(*[F.col(QUANTILE_COLUMNS[QUANTILES.index(q)]) for q in order]).alias("quantile_predictions"),
        ).alias("predicted_target"),
    )
    # SC11: the nested output is stored and read back with its declared schema.
    from ..session import shared_path
    from ..sources import sinks
    import uuid

    path = shared_path(spark, "io", f"nested-{uuid.uuid4().hex[:12]}")
    nested.write.mode("overwrite").parquet(path)
    stored = sinks.read_nested_output(spark, path)
    return rounded(flatten_nested(stored, "target", "series", "date", "seasonal_naive"))


# PR19 -> JN11 -> PR18: long -> response arrays -> long, keyed by series.
@register("response_arrays", _naive_sql("nation", NATION, FS.rounded_pred_select("fc")))
def q_response_arrays(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    ctx = contexts.series_contexts(prepped, NATION)
    fc = zero_shot.seasonal_naive(ctx, NATION.horizon, 7, "seasonal_naive")
    resp = contexts.to_response(fc).drop("model")
    return rounded(contexts.responses_to_frame(resp, ctx, "seasonal_naive"))


# WN2: horizon_step recomputed as the rank of date within series.
@register("horizon_rank", _naive_sql("supplier", SUPPLIER, FS.rounded_pred_select("fc")))
def q_horizon_rank(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    fc = zero_shot.seasonal_naive(contexts.series_contexts(prepped, SUPPLIER), SUPPLIER.horizon, 7, "seasonal_naive")
    return rounded(horizon_rank(fc.drop("horizon_step")).select(*fc.columns))


# FC3: normalised contexts (mean 0, std 1 per series), long form.
@register(
    "normalized_contexts",
    with_panel(
        "nation",
        """SELECT series, CAST(pos AS INTEGER) AS pos, ROUND((value - mu) / sd, 6) AS value
           FROM (SELECT series, mu, CASE WHEN sqrt(var) > 0 THEN sqrt(var) ELSE 1.0 END AS sd,
                        UNNEST(context) AS value, UNNEST(range(1, len(context) + 1)) AS pos
                 FROM (SELECT series, context, list_avg(context) AS mu,
                              list_var_pop(context) AS var
                       FROM ctx))""",
        NATION,
        extra=FS.contexts_cte("ctx", NATION.context_len),
    ),
)
def q_normalized(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    norm = zero_shot.normalize_contexts(contexts.series_contexts(prepped, NATION))
    long = norm.select("series", F.posexplode("context").alias("_p", "value")).select(
        "series", (F.col("_p") + 1).cast("int").alias("pos"), "value"
    )
    return rounded(long)


# JN7: predictions joined to TEST actuals (both models).
@register(
    "pred_actual_join",
    with_panel(
        "nation",
        "SELECT p.series, p.date, p.model, ROUND(p.forecast, 6) AS forecast, a.actual FROM preds p JOIN actual a USING (series, date)",
        NATION,
        extra=_two_model_ctes(NATION),
    ),
)
def q_pred_actual(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    preds = zero_shot_predictions(prepped, NATION)
    j = score.join_actuals(preds, actuals(prepped, NATION))
    return rounded(j.select("series", "date", "model", "forecast", "actual"))


# JN8: unmatched rows each way (suppliers: some series end before TEST).
@register(
    "overlap_counts",
    with_panel(
        "supplier",
        """SELECT model, CAST(COUNT(*) AS BIGINT) AS n_predictions,
                  CAST(COUNT(a.actual) AS BIGINT) AS n_matched,
                  CAST(COUNT(*) - COUNT(a.actual) AS BIGINT) AS predictions_unmatched,
                  CAST((SELECT COUNT(*) FROM actual) - COUNT(DISTINCT CASE WHEN a.actual IS NOT NULL THEN p.series || '|' || CAST(p.date AS VARCHAR) END) AS BIGINT) AS actuals_unmatched
           FROM preds p LEFT JOIN actual a USING (series, date) GROUP BY model""",
        SUPPLIER,
        extra=_two_model_ctes(SUPPLIER, horizon_b=7),
    ),
)
def q_overlap(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    ctx = contexts.series_contexts(prepped, SUPPLIER)
    preds = union_predictions(
        [
            zero_shot.seasonal_naive(ctx, SUPPLIER.horizon, 7, "seasonal_naive"),
            zero_shot.seasonal_naive(ctx, 7, 1, "last_value"),
        ]
    )
    return score.overlap_counts(preds, actuals(prepped, SUPPLIER))


_METRIC_ROUND = "ROUND(mae, 6) AS mae, ROUND(rmse, 6) AS rmse, ROUND(smape, 6) AS smape, ROUND(quantile_loss, 6) AS quantile_loss, n_points"


# AG15: overall metrics per model (one pass for both models).
@register(
    "eval_overall",
    with_panel(
        "nation",
        f"SELECT model, {_METRIC_ROUND} FROM m",
        NATION,
        extra=_two_model_ctes(NATION) + "," + FS.metrics_cte("m", "preds"),
    ),
)
def q_eval_overall(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    return rounded(score.evaluate(zero_shot_predictions(prepped, NATION), actuals(prepped, NATION)))


# AG16: per-series metrics per model, every supplier.
@register(
    "eval_per_series",
    with_panel(
        "supplier",
        f"SELECT model, series, {_METRIC_ROUND} FROM m",
        SUPPLIER,
        extra=_two_model_ctes(SUPPLIER) + "," + FS.metrics_cte("m", "preds", by="model, series"),
    ),
)
def q_eval_per_series(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    return rounded(
        score.evaluate_per_series(zero_shot_predictions(prepped, SUPPLIER), actuals(prepped, SUPPLIER))
    )


# WN4 + CM1: ranking (the flagship's output).
@register(
    "rank_models",
    with_panel(
        "nation",
        f"SELECT model, {_METRIC_ROUND.replace('n_points', 'CAST(n_points AS DOUBLE) AS n_points')}, rank, rank = 1 AS winner FROM rk",
        NATION,
        extra=_two_model_ctes(NATION) + "," + FS.metrics_cte("m", "preds") + "," + FS.rank_cte("rk", "m"),
    ),
)
def q_rank(spark, sf_dir):
    from .backtest import flagship

    return flagship(spark, sf_dir)


# CM2: parity warning when models were scored over different point counts
# (last value configured with a 7-day horizon vs 14 for the weekly naive).
@register(
    "parity_warning",
    with_panel(
        "nation",
        """SELECT CAST(COUNT(DISTINCT n_points) AS BIGINT) AS distinct_counts,
                  'unequal coverage, compare ranks with care: ' ||
                  string_agg(model || '=' || CAST(n_points AS VARCHAR), ', ' ORDER BY rank) || ' scored points' AS warning
           FROM rk WHERE n_points > 0 HAVING COUNT(DISTINCT n_points) > 1""",
        NATION,
        extra=_two_model_ctes(NATION, horizon_b=7) + "," + FS.metrics_cte("m", "preds") + "," + FS.rank_cte("rk", "m"),
    ),
)
def q_parity(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    ctx = contexts.series_contexts(prepped, NATION)
    preds = union_predictions(
        [
            zero_shot.seasonal_naive(ctx, NATION.horizon, 7, "seasonal_naive"),
            zero_shot.seasonal_naive(ctx, 7, 1, "last_value"),
        ]
    )
    ranking = compare.rank_models(score.evaluate(preds, actuals(prepped, NATION)))
    return compare.parity_warnings(ranking)


# EX1 + EX2 + EX3 + CM1: top_n x horizon sweep, two models, one job, ranked per variant.
SWEEP_AXES = {"data.station_filter.top_n": [5, 25], "forecast.horizon": [7, 14]}


def _sweep_sql() -> str:
    import itertools

    rows = []
    for top_n, h in itertools.product(*SWEEP_AXES.values()):
        rows.append(f"('top_n{top_n}-horizon{h}', {top_n}, {h}, {NATION.test_length})")
    values = ", ".join(rows)
    max_h = max(SWEEP_AXES["forecast.horizon"])
    extra = f"""
  variants AS (SELECT * FROM (VALUES {values}) v(variant, top_n, horizon, test_length)),
  ranks AS (SELECT series, ROW_NUMBER() OVER (ORDER BY n_rows DESC, series ASC) AS volume_rank FROM top),
  kept AS (SELECT p.series, p.date, CAST(p.target AS DOUBLE) AS y, v.variant, v.horizon, v.test_length
           FROM prepped p JOIN ranks r ON p.series = r.series JOIN variants v ON r.volume_rank <= v.top_n),
  vmax AS (SELECT variant, MAX(date) AS mx FROM kept GROUP BY variant),
  sp AS (SELECT k.*, CASE WHEN k.date > vmax.mx - k.test_length THEN 'TEST'
                          WHEN k.date > vmax.mx - (k.test_length + {NATION.validate_length}) THEN 'VALIDATE' ELSE 'TRAIN' END AS splits
         FROM kept k JOIN vmax ON k.variant = vmax.variant),
  sctx AS (SELECT variant, series, horizon, list(y ORDER BY date) AS context, MAX(date) AS last_date, COUNT(*) AS n
           FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY variant, series ORDER BY date DESC) AS rn FROM sp WHERE splits <> 'TEST')
           WHERE rn <= {NATION.context_len} GROUP BY variant, series, horizon),""" + FS.naive_cte(
        "sa", max_h, 7, "seasonal_naive", ctx="sctx", keys="variant, ", horizon_col="horizon"
    ) + "," + FS.naive_cte("sb", max_h, 1, "last_value", ctx="sctx", keys="variant, ", horizon_col="horizon") + f""",
  spreds AS (SELECT variant, {FS.PRED_COLS} FROM sa UNION ALL SELECT variant, {FS.PRED_COLS} FROM sb),
  sact AS (SELECT variant, series, date, y AS actual FROM sp WHERE splits = 'TEST'),
  sm AS (SELECT variant, model, {FS.metric_exprs()} FROM spreds p JOIN sact a USING (variant, series, date) GROUP BY variant, model),""" + FS.rank_cte("rk", "sm", partition="variant")
    body = (
        "SELECT variant, model, ROUND(mae, 6) AS mae, ROUND(rmse, 6) AS rmse, ROUND(smape, 6) AS smape, "
        "ROUND(quantile_loss, 6) AS quantile_loss, CAST(n_points AS DOUBLE) AS n_points, rank, rank = 1 AS winner FROM rk"
    )
    return with_panel("nation", body, NATION, extra=extra)


def _sweep_ranked(spark, sf_dir):
    from ..operators import sweep
    from ..sources import adapters

    largest = NATION.replace(top_n=max(SWEEP_AXES["data.station_filter.top_n"]))
    prepped = prepped_for(spark, sf_dir, "nation", largest)
    grid = sweep.doe_grid(spark, SWEEP_AXES, NATION)
    trips = adapters.nation_trips(spark, sf_dir)
    panel, variants = sweep.sweep_panel(trips, prepped, grid, NATION, counts_for(spark, sf_dir, "nation"))
    preds = sweep.sweep_naive(panel, variants, {"seasonal_naive": 7, "last_value": 1})
    return grid, sweep.sweep_scores(preds, sweep.sweep_actuals(panel, variants))


# EX4 + EX5 + CM3: run records (overrides map, metrics map) in a Parquet run log
# partitioned by experiment and run, written twice (a run replaces itself), read back.
@register(
    "run_log_round_trip",
    _sweep_sql().replace(
        "SELECT variant, model, ROUND(mae, 6) AS mae",
        "SELECT 'sweep' AS experiment, 'sweep__' || variant || '__' || model AS run, variant, model, ROUND(mae, 6) AS mae",
    ),
)
def q_run_log(spark, sf_dir):
    from ..operators import sweep
    from ..session import shared_path
    from ..sources.tables import materialize
    import uuid

    grid, ranked = _sweep_ranked(spark, sf_dir)
    root = shared_path(spark, "runlog", uuid.uuid4().hex[:12])
    ranked = materialize(ranked, "ranking")
    for _ in range(2):
        sweep.write_run_log(sweep.run_records(ranked, grid, "sweep"), root)
    back = sweep.read_run_log(spark, root, "sweep")
    m = F.col("metrics")
    return rounded(
        back.select(
            F.col("experiment").cast("string").alias("experiment"),
            F.col("run").cast("string").alias("run"),
            "variant",
            "model",
            *[m[k].alias(k) for k in ("mae", "rmse", "smape", "quantile_loss", "n_points")],
            "rank",
            "winner",
        )
    )


@register("doe_sweep_scores", _sweep_sql())
def q_sweep(spark, sf_dir):
    _, ranked = _sweep_ranked(spark, sf_dir)
    return rounded(ranked)


# EX3 + EX4 + EX5: every model on every variant's own panel, with parameters, configuration and predictions
# stored per run; equal to the one-plan sweep above.
@register(
    "sweep_artifacts",
    _sweep_sql().replace(
        "SELECT variant, model, ROUND(mae, 6) AS mae",
        "SELECT 'artifacts' AS experiment, variant, model, regexp_extract(variant, 'horizon([0-9]+)', 1) AS horizon, "
        "regexp_extract(variant, 'top_n([0-9]+)', 1) AS top_n, ROUND(mae, 6) AS mae",
    ),
)
def q_sweep_artifacts(spark, sf_dir):
    log, _ = _stored_sweep(spark, sf_dir)
    m, p = F.col("metrics"), F.col("parameters")
    return rounded(
        log.select(
            "experiment", "variant", "model", p["horizon"].alias("horizon"), p["top_n"].alias("top_n"),
            *[m[k].alias(k) for k in ("mae", "rmse", "smape", "quantile_loss", "n_points")], "rank", "winner",
        )
    )


def _stored_sweep(spark, sf_dir):
    from ..operators import sweep
    from ..session import shared_path
    import uuid

    def naive(period, name):
        def model(prepped, cfg):
            return zero_shot.seasonal_naive(contexts.series_contexts(prepped, cfg), cfg.horizon, period, name)

        return model

    root = shared_path(spark, "sweeps", uuid.uuid4().hex[:12])
    models = {"seasonal_naive": naive(7, "seasonal_naive"), "last_value": naive(1, "last_value")}
    log = sweep.run_sweep(lambda c: prepped_for(spark, sf_dir, "nation", c), SWEEP_AXES, NATION, models, "artifacts", root)
    return log, root


# EX5: the stored predictions and configuration of every run, read back (every value of both).
@register(
    "run_artifacts",
    _sweep_sql().split("SELECT variant, model, ROUND(mae, 6) AS mae")[0]
    + "SELECT p.variant, p.series, p.date, p.horizon_step, ROUND(p.forecast, 6) AS forecast, ROUND(p.q10, 6) AS q10, ROUND(p.q90, 6) AS q90, "
    + "p.model, CAST(v.horizon AS VARCHAR) AS horizon, CAST(v.top_n AS VARCHAR) AS top_n, CAST(v.test_length AS VARCHAR) AS test_length "
    + "FROM spreds p JOIN variants v USING (variant)",
)
def q_run_artifacts(spark, sf_dir):
    from ..operators import sweep

    _, root = _stored_sweep(spark, sf_dir)
    predictions, config = sweep.read_artifacts(spark, "artifacts", root)
    fields = [F.get_json_object("config", f"$.{k}").alias(k) for k in ("horizon", "top_n", "test_length")]
    joined = predictions.join(F.broadcast(config.select("variant", *fields)), "variant")  # a row per variant
    return rounded(
        joined.select("variant", "series", "date", "horizon_step", "forecast", "q10", "q90", "model", "horizon", "top_n", "test_length")
    )


# AG15 + AG16 in one aggregation (grouping sets): overall rows have series NULL.
@register(
    "eval_grouping_sets",
    with_panel(
        "supplier",
        f"""SELECT model, series, CASE WHEN GROUPING(series) = 1 THEN 'overall' ELSE 'series' END AS level,
                   ROUND(mae, 6) AS mae, ROUND(rmse, 6) AS rmse, ROUND(smape, 6) AS smape,
                   ROUND(quantile_loss, 6) AS quantile_loss, n_points
            FROM (SELECT model, series, GROUPING(series) AS g, {FS.metric_exprs()}
                  FROM preds p JOIN actual a USING (series, date)
                  GROUP BY GROUPING SETS ((model), (model, series))) t""".replace("GROUPING(series) = 1", "g = 1"),
        SUPPLIER,
        extra=_two_model_ctes(SUPPLIER),
    ),
)
def q_eval_sets(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    return rounded(score.evaluate_both(zero_shot_predictions(prepped, SUPPLIER), actuals(prepped, SUPPLIER)))
