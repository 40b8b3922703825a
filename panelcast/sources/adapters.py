"""Adapters: present the driver's test tables in the shapes the panel build reads.

* ``*_trips``  -> canonical event facts (``schemas.TRIPS``)
* ``weather_shards`` -> raw sharded covariate rows (``schemas.WEATHER_RAW``)
* ``customer_meta`` -> dimension rows (``schemas.META``)

Each is a lazy projection/join; Catalyst fuses it into the consuming plan and
prunes the columns it does not need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PanelConfig, WeatherSpec
from .scans import scan_meta, scan_trips

# How the test tables map onto the event-fact roles.
SUBSCRIBER = "Subscriber"
CUSTOMER = "Customer"
MALE, FEMALE, OTHER = "male", "female", "other"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _roles(usertype_cond, gender_col, male_value, female_value):
    usertype = F.when(usertype_cond, F.lit(SUBSCRIBER)).when(usertype_cond.isNotNull(), F.lit(CUSTOMER))
    gender = (
        F.when(gender_col == F.lit(male_value), F.lit(MALE))
        .when(gender_col == F.lit(female_value), F.lit(FEMALE))
        .when(gender_col.isNotNull(), F.lit(OTHER))
    )
    return usertype, gender


def nation_trips(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """orders x customer x nation; series = nation name, id = customer key.

    ``nation`` is a fixed 25-row dimension at every scale, so it is broadcast;
    orders x customer is a shuffle join on the customer key (AQE may switch it
    to a broadcast at run time when the customer side turns out small).
    """
    orders = read(spark, sf_dir, "orders") if facts is None else facts
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")
    facts = orders.join(cust, orders.o_custkey == cust.c_custkey)
    usertype, gender = _roles(F.col("o_orderstatus") == F.lit("F"), F.col("o_orderpriority"), "1-URGENT", "2-HIGH")
    return facts.select(
        F.col("n_name").alias("series"),
        F.col("o_orderdate").alias("starttime"),
        F.col("o_totalprice").cast("double").alias("tripduration"),
        usertype.alias("usertype"),
        gender.alias("gender"),
        F.col("c_custkey").cast("long").alias("start_station_id"),
        *keep,
    )


def supplier_trips(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """lineitem; series = supplier key, id = part key (many series, scale case)."""
    li = read(spark, sf_dir, "lineitem") if facts is None else facts
    usertype, gender = _roles(F.col("l_returnflag") == F.lit("N"), F.col("l_linestatus"), "O", "F")
    return li.select(
        F.col("l_suppkey").cast("string").alias("series"),
        F.col("l_shipdate").alias("starttime"),
        F.col("l_extendedprice").cast("double").alias("tripduration"),
        usertype.alias("usertype"),
        gender.alias("gender"),
        F.col("l_partkey").cast("long").alias("start_station_id"),
        *keep,
    )


def user_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events; series = user id, no id column (short-history case)."""
    ev = read(spark, sf_dir, "events")
    usertype, gender = _roles(F.col("event_type") == F.lit("purchase"), F.col("event_type"), "click", "view")
    return ev.select(
        F.col("user_id").cast("string").alias("series"),
        F.col("ts").alias("starttime"),
        F.col("value").cast("double").alias("tripduration"),
        usertype.alias("usertype"),
        gender.alias("gender"),
        F.lit(None).cast("long").alias("start_station_id"),
    )


def weather_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily covariate rows cut from lineitem, one row per (day, flag, status)."""
    li = read(spark, sf_dir, "lineitem")
    d = F.to_date("l_shipdate")
    daily = li.groupBy(d.alias("d"), F.col("l_returnflag").alias("stn"), F.col("l_linestatus").alias("wban")).agg(
        F.avg("l_quantity").alias("temp"), F.min("l_tax").alias("prcp")
    )
    return daily.select(
        F.date_format("d", "yyyy").alias("year"),
        F.date_format("d", "MM").alias("mo"),
        F.date_format("d", "dd").alias("da"),
        "stn",
        "wban",
        F.col("temp").cast("double").alias("temp"),
        F.col("prcp").cast("double").alias("prcp"),
    )


def customer_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension keyed by the customer key as a string (the fact id is a long).

    The name is the key's text, which the suppliers' series share, so that a
    join by name has partners; a negative balance stands for no capacity.
    """
    c = read(spark, sf_dir, "customer")
    balance = F.col("c_acctbal").cast("long")
    return c.select(
        F.col("c_custkey").cast("string").alias("station_id"),
        F.col("c_custkey").cast("string").alias("name"),
        F.when(balance >= 0, balance).alias("capacity"),
        F.col("c_nationkey").cast("long").alias("region_id"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
    )


# Weather station + sentinels used with the adapters (prcp 0.0 marks a missing reading).
ADAPTER_WEATHER = WeatherSpec(
    stn="N", wban="O", temp_missing=9999.9, prcp_missing=0.0, default_start_year="1990", default_end_year="2029"
)

# Per-adapter back-test settings (test / validate / horizon, top-N).
ADAPTER_CONFIGS: dict[str, PanelConfig] = {
    "nation": PanelConfig(top_n=25, test_length=14, validate_length=14, horizon=14, weather=ADAPTER_WEATHER),
    "supplier": PanelConfig(top_n=10, test_length=14, validate_length=14, horizon=14, weather=ADAPTER_WEATHER),
    "user": PanelConfig(top_n=10, test_length=5, validate_length=5, horizon=5, weather=ADAPTER_WEATHER),
}

TRIPS_ADAPTERS = {"nation": nation_trips, "supplier": supplier_trips, "user": user_trips}
#: The tables that an adapter's facts come from, and those of its weather and metadata.
FACT_TABLES = {"nation": ("orders", "customer", "nation"), "supplier": ("lineitem",), "user": ("events",)}
COVARIATE_TABLES = ("lineitem", "customer")


def input_paths(sf_dir: str, adapter: str, covariates: bool = True) -> list[str]:
    """The files and folders that an adapter reads."""
    names = dict.fromkeys([*FACT_TABLES[adapter], *(COVARIATE_TABLES if covariates else ())])
    return [f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names]


def adapter_inputs(spark: SparkSession, sf_dir: str, adapter: str = "nation"):
    """(trips, weather_raw, meta, cfg) for one adapter."""
    return (
        scan_trips(TRIPS_ADAPTERS[adapter](spark, sf_dir)),
        weather_shards(spark, sf_dir),
        scan_meta(customer_meta(spark, sf_dir)),
        ADAPTER_CONFIGS[adapter],
    )
