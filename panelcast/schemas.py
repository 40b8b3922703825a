"""Declared schemas of the fixed frames, asserted at operator boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .config import QUANTILE_COLUMNS, PanelConfig

# Canonical event-fact ("trips") columns every adapter produces.
TRIPS = T.StructType(
    [
        T.StructField("series", T.StringType()),
        T.StructField("starttime", T.TimestampNTZType()),
        T.StructField("tripduration", T.DoubleType()),
        T.StructField("usertype", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("start_station_id", T.LongType()),
    ]
)

# Raw sharded covariate ("weather") columns.
WEATHER_RAW = T.StructType(
    [
        T.StructField("year", T.StringType()),
        T.StructField("mo", T.StringType()),
        T.StructField("da", T.StringType()),
        T.StructField("stn", T.StringType()),
        T.StructField("wban", T.StringType()),
        T.StructField("temp", T.DoubleType()),
        T.StructField("prcp", T.DoubleType()),
    ]
)

# Dimension ("station metadata") columns.
META = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("capacity", T.LongType()),
        T.StructField("region_id", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

MEASURES = ("avg_tripduration", "pct_subscriber", "ratio_gender")


def source_schema(cfg: PanelConfig) -> T.StructType:
    return T.StructType(
        [
            T.StructField(cfg.series_column, T.StringType()),
            T.StructField(cfg.time_column, T.DateType()),
            T.StructField(cfg.target_column, T.LongType()),
            T.StructField("avg_tripduration", T.DoubleType()),
            T.StructField("pct_subscriber", T.DoubleType()),
            T.StructField("ratio_gender", T.DoubleType()),
            T.StructField("temp", T.DoubleType()),
            T.StructField("prcp", T.DoubleType()),
            T.StructField("day_of_week", T.LongType()),
            T.StructField("month", T.LongType()),
            T.StructField("is_weekend", T.LongType()),
            T.StructField("station_id", T.LongType()),
            T.StructField("capacity", T.LongType()),
            T.StructField("region_id", T.LongType()),
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
        ]
    )


def prepped_schema(cfg: PanelConfig) -> T.StructType:
    return T.StructType([*source_schema(cfg).fields, T.StructField("splits", T.StringType())])


# Long prediction frame, one row per series x forecast date x model.
PREDICTIONS = T.StructType(
    [
        T.StructField("series", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("horizon_step", T.IntegerType()),
        T.StructField("forecast", T.DoubleType()),
        *[T.StructField(q, T.DoubleType()) for q in QUANTILE_COLUMNS],
        T.StructField("model", T.StringType()),
    ]
)
PREDICTION_COLUMNS = tuple(f.name for f in PREDICTIONS.fields)

METRIC_COLUMNS = ("mae", "rmse", "smape", "quantile_loss", "n_points")

# Batch-inference interchange rows.
REQUEST = T.StructType(
    [T.StructField("series_id", T.StringType()), T.StructField("context", T.ArrayType(T.DoubleType()))]
)
RESPONSE = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("forecast", T.ArrayType(T.DoubleType())),
        *[T.StructField(q, T.ArrayType(T.DoubleType())) for q in QUANTILE_COLUMNS],
    ]
)


def assert_columns(df: DataFrame, schema: T.StructType, what: str) -> None:
    """Fail fast (driver-side, no job) when a frame lacks a declared column or type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{what}: " + "; ".join(problems))


def declared(df: DataFrame, schema: T.StructType, what: str) -> DataFrame:
    """The declared columns of a frame that has them in the declared types."""
    assert_columns(df, schema, what)
    return df.select(*schema.fieldNames())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select + cast to exactly ``schema`` (column order and types)."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
