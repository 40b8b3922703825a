"""TB1/TB5: the panel's facts as a mergeable state keyed by input file, so that a new file costs a pass over that file alone.

The state has, per (input file, series, id, day), counts and sums with their non-null counts: whatever the panel takes from the facts
(events and shares per day, events per series and id) is a sum over it. An update lists the files (one Spark job, no content),
reads those that no committed batch holds, in lots of ``LOT`` paths, and appends their rows as a batch. The batch's entry in the
list of files is written after its rows and names them: rows without an entry, of a failed update, are never read, and files that
changed or went are left out the same way.

What moves: the facts once by the state's key, the state's rows once by (series, day) and once by (series, share of its ids), each with the columns
that are summed alone; the list of files is broadcast (a row per file). Rows are dealt out by key before they are summed: nearly every
key is met once, so that sums taken before the exchange would hold a whole split's rows in memory, and spill them, to save nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PanelConfig
from ..functions.scalar import safe_ratio, to_day, valid_key
from ..sources.tables import _exists

#: Paths of one read.
LOT = 10_000
#: Rows that one task sums: their sums fit its memory, whatever the size of an update or of the state.
PART = 500_000
#: Tasks over which a series' ids are spread: its modal id is then found among so many rows at most.
SPREAD = 16
FILE = "_file"
KEYS = ("file", "series", "start_station_id", "day")
SUMS = ("n", "duration", "duration_n", "subscribers", "men", "known")


def _key(path: Column, size: Column, modified: Column) -> Column:
    plain = F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")
    return F.substring(F.sha2(F.concat_ws("|", plain, size.cast("string"), F.unix_millis(modified).cast("string")), 256), 1, 20)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(file, path) of every file below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path)
    return files.select(_key(F.col("path"), F.col("length"), F.col("modificationTime")).alias("file"), "path")


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The facts of some files with the key of each row's file."""
    m = "_metadata"
    path = F.url_decode(F.replace(F.col(f"{m}.file_path"), F.lit("+"), F.lit("%2B")))
    key = _key(path, F.col(f"{m}.file_size"), F.col(f"{m}.file_modification_time"))
    return spark.read.parquet(*paths).select("*", key.alias(FILE))


def _parts(rows: DataFrame) -> int:
    return -(-rows.count() // PART) or 1


def state_rows(trips: DataFrame, parts: int) -> DataFrame:
    """The state of facts that carry their file's key, summed in ``parts`` tasks."""
    gender = F.col("gender")
    facts = trips.where(valid_key("series")).select(
        F.col(FILE).alias("file"), "series", "start_station_id", to_day("starttime").alias("day"), "tripduration",
        (F.col("usertype") == F.lit("Subscriber")).alias("subscriber"),
        (gender == F.lit("male")).alias("man"), gender.isin("male", "female").alias("of_known"),
    )
    return facts.repartition(parts, *KEYS).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("tripduration").alias("duration"), F.count("tripduration").alias("duration_n"),
        F.count_if("subscriber").alias("subscribers"), F.count_if("man").alias("men"), F.count_if("of_known").alias("known"),
    )


def _committed(spark: SparkSession, root: str) -> DataFrame:
    if not _exists(spark, f"{root}/files"):
        return spark.createDataFrame([], "file string, batch string")
    return spark.read.schema("file string, batch string").parquet(f"{root}/files")


def _lots(rows: Iterator, size: int) -> Iterator[list[str]]:
    lot: list[str] = []
    for r in rows:
        lot.append(r["path"])
        if len(lot) == size:
            yield lot
            lot = []
    if lot:
        yield lot


def update(spark: SparkSession, facts: str, root: str, trips: Callable[[DataFrame], DataFrame], lot: int = LOT) -> int:
    """Bring the state at ``root`` up to the files below ``facts``; returns how many files were read. ``trips`` turns facts with the
    column ``FILE`` into canonical events that still have it."""
    fresh = listing(spark, facts).join(_committed(spark, root).select("file"), "file", "left_anti")
    read = 0
    for paths in _lots(fresh.select("path").distinct().toLocalIterator(), lot):
        batch = uuid.uuid4().hex
        part = read_files(spark, paths)
        state_rows(trips(part), _parts(part)).write.parquet(f"{root}/rows/batch={batch}")
        own = spark.createDataFrame([(p,) for p in paths], "path string")
        names = listing(spark, facts).join(own, "path")
        names.select("file").distinct().write.parquet(f"{root}/files/batch={batch}")
        read += len(paths)
    return read


def current(spark: SparkSession, facts: str, root: str) -> DataFrame:
    """The state's rows of the files that are there now."""
    rows = spark.read.option("basePath", f"{root}/rows").parquet(f"{root}/rows")
    rows = rows.withColumn("batch", F.col("batch").cast("string"))
    files = listing(spark, facts).select("file").join(_committed(spark, root), "file")
    one = files.groupBy("file").agg(F.min("batch").alias("batch"))  # two updates at once may have read a file twice
    return rows.join(F.broadcast(one), ["file", "batch"], "left_semi")  # the state's rows stay where they are


# -- what the panel takes from the facts -----------------------------------------------
def id_counts(state: DataFrame) -> DataFrame:
    share = F.pmod(F.hash("start_station_id"), F.lit(SPREAD)).alias("_share")
    rows = state.select("series", share, "start_station_id", "n").repartition(_parts(state), "series", "_share")
    return rows.groupBy("series", "_share", "start_station_id").agg(F.sum("n").alias("cnt")).drop("_share")


def daily(state: DataFrame, top: DataFrame | None, cfg: PanelConfig) -> DataFrame:
    """Per (series, day) as ``panel.daily_panel``, by sums over the state."""
    rows = state if top is None else state.join(top.select("series"), "series", "left_semi")
    first, last = cfg.window()
    if first:
        rows = rows.where(F.col("day") >= F.lit(first))
    if last:
        rows = rows.where(F.col("day") <= F.lit(last))
    total = {c: F.sum(c) for c in SUMS}
    rows = rows.select("series", "day", *SUMS).repartition(_parts(rows), "series", "day")
    return rows.groupBy(F.col("series").alias(cfg.series_column), F.col("day").alias(cfg.time_column)).agg(
        total["n"].alias(cfg.target_column), safe_ratio(total["duration"], total["duration_n"]).alias("avg_tripduration"),
        safe_ratio(total["subscribers"].cast("double"), total["n"]).alias("pct_subscriber"),
        safe_ratio(total["men"], total["known"]).alias("ratio_gender"),
    )
