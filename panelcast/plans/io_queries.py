"""Registered round trips through the sinks (SC4, SC7-SC12, TB5). Each writes
under the shared checkpoint folder and reads back with an explicit schema."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import fingerprint
from ..operators import contexts
from ..operators.forecast import zero_shot
from ..sources import sinks
from ..sources.tables import ensure_table, table_properties, write_table
from ..session import shared_path
from . import forecast_sql as FS
from .backtest import flagship, prepped_for, source_fingerprint
from .common import NATION, SUPPLIER, rounded
from .oracle_sql import SOURCE_COLS, with_panel
from . import forecast_queries  # noqa: F401  (registers rank_models first)
from .registry import ORACLE, register


def _path(spark, what: str) -> str:
    return shared_path(spark, "io", f"{what}-{uuid.uuid4().hex[:12]}")


def _naive(spark, sf_dir, cfg, adapter):
    prepped = prepped_for(spark, sf_dir, adapter, cfg)
    ctx = contexts.series_contexts(prepped, cfg)
    return ctx, zero_shot.seasonal_naive(ctx, cfg.horizon, 7, "seasonal_naive")


_NAIVE_SQL = with_panel(
    "supplier",
    FS.rounded_pred_select("fc"),
    SUPPLIER,
    extra=FS.contexts_cte("ctx", SUPPLIER.context_len) + "," + FS.naive_cte("fc", SUPPLIER.horizon, 7, "seasonal_naive"),
)


# SC7: predictions -> Parquet partitioned by model -> read with the schema.
@register("predictions_round_trip", _NAIVE_SQL)
def q_pred_parquet(spark, sf_dir):
    _, fc = _naive(spark, sf_dir, SUPPLIER, "supplier")
    path = _path(spark, "predictions")
    sinks.write_predictions(fc, path)
    return rounded(sinks.read_predictions(spark, path))


# SC8: predictions -> CSV with header -> read with the schema.
@register("predictions_csv_round_trip", _NAIVE_SQL)
def q_pred_csv(spark, sf_dir):
    _, fc = _naive(spark, sf_dir, SUPPLIER, "supplier")
    path = _path(spark, "predictions-csv")
    sinks.write_predictions_csv(rounded(fc), path)
    return rounded(sinks.read_predictions_csv(spark, path))


def _requests_sql(values: str) -> str:
    return with_panel(
        "supplier",
        "SELECT series_id, CAST(pos AS INTEGER) AS pos, ROUND(value, 6) AS value FROM ("
        "SELECT series AS series_id, UNNEST(c) AS value, UNNEST(range(1, len(c) + 1)) AS pos "
        f"FROM (SELECT series, {values} AS c FROM ctx))",
        SUPPLIER,
        extra=FS.contexts_cte("ctx", SUPPLIER.context_len),
    )


def _long_requests(requests):
    return rounded(
        requests.select("series_id", F.posexplode("context").alias("_p", "value")).select(
            "series_id", (F.col("_p") + 1).cast("int").alias("pos"), "value"
        )
    )


# SC9: requests as JSON lines, read back, every value.
@register("jsonl_round_trip", _requests_sql("context"))
def q_requests(spark, sf_dir):
    ctx, _ = _naive(spark, sf_dir, SUPPLIER, "supplier")
    path = _path(spark, "requests")
    sinks.write_requests(ctx, path)
    return _long_requests(sinks.read_requests(spark, path))


# PR20: requests cut to their last 128 values (the operator's own limit).
@register(
    "truncated_requests",
    _requests_sql("CASE WHEN len(context) > 128 THEN context[len(context) - 127:] ELSE context END"),
)
def q_truncated(spark, sf_dir):
    ctx, _ = _naive(spark, sf_dir, SUPPLIER, "supplier")
    return _long_requests(contexts.truncate_context(ctx.withColumnRenamed("series", "series_id"), 128))


# SC10 + JN11: responses as JSON lines, read with the schema, joined to last dates by series.
@register("responses_round_trip", _NAIVE_SQL)
def q_responses(spark, sf_dir):
    ctx, fc = _naive(spark, sf_dir, SUPPLIER, "supplier")
    path = _path(spark, "responses")
    sinks.write_responses(contexts.to_response(fc).drop("model"), path)
    asked = ctx.select(F.col("series").alias("series_id"))
    responses = sinks.complete_responses(sinks.response_lines(spark, path), asked)
    return rounded(contexts.responses_to_frame(responses, ctx, "seasonal_naive"))


# SC10: a batch output with broken, cut, repeated and lost lines, each counted. Suppliers by their key modulo 10: 1 is lost,
# 2 breaks off, 3 has a short array, 4 comes twice; and one response that nobody asked for.
@register(
    "response_account",
    with_panel(
        "supplier",
        """SELECT status, CAST(SUM(n) AS BIGINT) AS n FROM (
             SELECT CASE CAST(series AS BIGINT) % 10 WHEN 1 THEN 'missing' WHEN 2 THEN 'malformed' WHEN 3 THEN 'incomplete' ELSE 'ok' END AS status, 1 AS n FROM ctx
             UNION ALL SELECT 'missing', 1 FROM ctx WHERE CAST(series AS BIGINT) % 10 IN (2, 3)
             UNION ALL SELECT 'repeated', 1 FROM ctx WHERE CAST(series AS BIGINT) % 10 = 4
             UNION ALL SELECT 'unexpected', 1) GROUP BY status""",
        SUPPLIER,
        extra=FS.contexts_cte("ctx", SUPPLIER.context_len),
    ),
)
def q_account(spark, sf_dir):
    ctx, fc = _naive(spark, sf_dir, SUPPLIER, "supplier")
    key = F.pmod(F.col("series_id").cast("long"), F.lit(10))
    responses = contexts.to_response(fc).drop("model").where(key != 1)
    whole = F.to_json(F.struct(*responses.columns))
    short = F.to_json(F.struct(*[F.slice(c, 1, 3).alias(c) if c == "q30" else F.col(c) for c in responses.columns]))
    line = F.when(key == 2, F.substring(whole, 1, 40)).when(key == 3, short).otherwise(whole)
    lines = responses.select(F.explode(F.when(key == 4, F.array(line, line)).otherwise(F.array(line))).alias("value"))
    stray = responses.limit(1).select(F.to_json(F.struct(F.lit("nobody").alias("series_id"), *[c for c in responses.columns if c != "series_id"])).alias("value"))
    path = _path(spark, "response-lines")
    lines.unionByName(stray).write.text(path)
    return sinks.account(sinks.response_lines(spark, path), ctx.select(F.col("series").alias("series_id")))


# SC12: ranking -> JSON -> read back (same twin as the ranking itself).
@register("ranking_json_round_trip", ORACLE["rank_models"])
def q_ranking_json(spark, sf_dir):
    ranking = flagship(spark, sf_dir)
    path = _path(spark, "ranking")
    sinks.write_ranking(ranking, path)
    return sinks.read_ranking(spark, path, ranking.schema)


# SC4 + SC13 + TB5: fingerprint-guarded table write (replace-on-write), read back.
@register("table_round_trip", with_panel("nation", f"SELECT {SOURCE_COLS}, splits FROM prepped"))
def q_table(spark, sf_dir):
    path = _path(spark, "prepped-table")
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    fp = fingerprint({"source": source_fingerprint(spark, sf_dir, "nation", NATION), **NATION.prepped_fields()})
    ensure_table(spark, path, fp, lambda: prepped)
    table, rebuilt = ensure_table(spark, path, fp, lambda: prepped.limit(0))  # current: the skip branch
    if rebuilt:
        raise RuntimeError("a current table was rebuilt")
    return rounded(table)


# SC13: the row count observed by the write itself, with labels and description.
@register(
    "table_row_count",
    with_panel("nation", "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, 'daily' AS grain, 'prepped panel' AS description FROM prepped"),
)
def q_table_count(spark, sf_dir):
    path = _path(spark, "counted-table")
    prepped = prepped_for(spark, sf_dir, "nation", NATION)
    write_table(prepped, path, labels={"grain": "daily"}, description="prepped panel")
    p = table_properties(spark, path)
    return spark.createDataFrame([(p["rows"], p["labels"]["grain"], p["description"])], "n_rows long, grain string, description string")


