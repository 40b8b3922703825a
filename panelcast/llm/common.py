"""Helpers shared by the text operators: written intermediate tables, table reads, small numeric code."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import shared_path, ship_package

#: Rows of whole texts in one Arrow batch: bounds what a Python worker holds at once.
ARROW_ROWS = 512
#: Bytes of a batch, so that long texts don't meet in one.
ARROW_BYTES = 32 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package to Python workers and bound the rows and bytes of an Arrow batch."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: cuts the
    lineage, survives the loss of executors and gives Catalyst the measured size."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_train(doc_id) -> F.Column:
    """Rows whose labels may be learned from: crc32 of the id as text, mod 4, is not 2."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) != 2
