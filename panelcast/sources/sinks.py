"""Sinks and interchange formats (SC7-SC10, SC12). Every reader gives the
schema explicitly -- nothing is inferred -- and every writer writes a
directory of part files in parallel (no coalesce to one file)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PREDICTIONS, REQUEST, RESPONSE, conform


# -- SC7 --------------------------------------------------------------------
def write_predictions(preds: DataFrame, path: str) -> None:
    conform(preds, PREDICTIONS).write.mode("overwrite").partitionBy("model").parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.schema(PREDICTIONS).parquet(path), PREDICTIONS)


# -- SC8 --------------------------------------------------------------------
def write_predictions_csv(preds: DataFrame, path: str) -> None:
    conform(preds, PREDICTIONS).write.mode("overwrite").option("header", True).csv(path)


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(PREDICTIONS).csv(path)


# -- SC9 --------------------------------------------------------------------
def write_requests(contexts: DataFrame, path: str) -> None:
    """Batch-inference requests as JSON lines {"series_id", "context": [...]}."""
    contexts.select(F.col("series").cast("string").alias("series_id"), F.col("context").cast("array<double>")).write.mode(
        "overwrite"
    ).json(path)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REQUEST).json(path)


# -- SC10 -------------------------------------------------------------------
def write_responses(responses: DataFrame, path: str) -> None:
    conform(responses, RESPONSE).write.mode("overwrite").json(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Responses {series_id, horizon, forecast[], q10[] ... q90[]}, schema given. Lines that can't be used are not among them:
    ``response_lines`` has every line, ``account`` counts them."""
    return response_lines(spark, path).where("status = 'ok'").select(*RESPONSE.fieldNames())


def response_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the responses with its status: ``malformed`` (no JSON of the schema, or without series, horizon or forecast),
    ``incomplete`` (an array of another length than the horizon, or a value that is none), ``repeated`` (a later line of a
    series that has a usable one), else ``ok``; ``line`` holds what was read, the reject table's text."""
    raw = spark.read.text(path).select(
        F.col("value").alias("line"), F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id()).alias("_at")
    )
    schema = T.StructType([*RESPONSE.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = raw.select("*", parsed.alias("p")).select("line", "_at", "p.*")
    arrays = [f.name for f in RESPONSE.fields if isinstance(f.dataType, T.ArrayType)]
    malformed = (
        F.col("_corrupt_record").isNotNull() | F.col("series_id").isNull() | F.col("horizon").isNull() | F.col("forecast").isNull()
    )
    whole = [F.coalesce((F.size(a) == F.col("horizon")) & F.forall(a, lambda v: v.isNotNull()), F.lit(False)) for a in arrays]
    usable = whole[0]
    for w in whole[1:]:
        usable = usable & w
    first = F.when(malformed, F.lit("malformed")).when(~usable, F.lit("incomplete")).otherwise(F.lit("ok"))
    rows = rows.withColumn("status", first)
    # the first usable line of a series stays: partial minima by series, so a series of many lines is no task's window
    firsts = rows.where("status = 'ok'").groupBy("series_id").agg(F.min("_at").alias("_first"))
    rows = rows.join(firsts, "series_id", "left")
    again = (F.col("status") == "ok") & (F.col("_at") != F.col("_first"))
    return rows.withColumn("status", F.when(again, F.lit("repeated")).otherwise(F.col("status"))).select(*RESPONSE.fieldNames(), "line", "status")


def rejects(lines: DataFrame) -> DataFrame:
    """The reject table: status, series_id (where known) and the line itself."""
    return lines.where("status <> 'ok'").select("status", "series_id", "line")


def account(lines: DataFrame, requests: DataFrame) -> DataFrame:
    """(status, n) over everything sent and received: the lines by status, of the usable ones those that nobody asked for
    (``unexpected``), and the requests without a usable response (``missing``)."""
    asked = requests.select("series_id").distinct().withColumn("asked", F.lit(True))
    got = lines.where("status = 'ok'").select("series_id", F.lit(True).alias("got"))
    both = asked.join(got, "series_id", "full")
    matched = F.when(F.col("asked") & F.col("got"), "ok").when(F.col("asked"), "missing").otherwise("unexpected")
    return (
        lines.where("status <> 'ok'").select("status").unionByName(both.select(matched.alias("status")))
        .groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    )


def complete_responses(lines: DataFrame, requests: DataFrame) -> DataFrame:
    """The usable response of every request; a request without one fails the job by its series, in the plan that reads it."""
    ok = lines.where("status = 'ok'").select(*RESPONSE.fieldNames())
    asked = requests.select("series_id").distinct()
    found = asked.join(ok.withColumn("_got", F.lit(True)), "series_id", "left")
    lost = F.raise_error(F.concat(F.lit("no usable response for series "), F.coalesce(F.col("series_id"), F.lit("NULL"))))
    return found.withColumn("horizon", F.when(F.col("_got"), F.col("horizon")).otherwise(lost.cast("int"))).select(*RESPONSE.fieldNames())


# -- SC11 -------------------------------------------------------------------
NESTED_OUTPUT = T.StructType(
    [
        T.StructField("series", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField(
            "predicted_target",
            T.StructType(
                [
                    T.StructField("value", T.DoubleType()),
                    T.StructField("quantile_values", T.ArrayType(T.DoubleType())),
                    T.StructField("quantile_predictions", T.ArrayType(T.DoubleType())),
                ]
            ),
        ),
    ]
)


def read_nested_output(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NESTED_OUTPUT).parquet(path)


# -- SC12 -------------------------------------------------------------------
def write_ranking(ranking: DataFrame, path: str) -> None:
    ranking.write.mode("overwrite").json(path)


def read_ranking(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
