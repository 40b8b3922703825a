"""Materialisation of derived tables (SC4, SC13, TB5).

* ``materialize``      cut lineage with a reliable checkpoint in the shared
                        folder named by ``spark.checkpoint.dir`` (survives
                        executor loss; never a local checkpoint).
* ``write_table``      replace-on-write Parquet table + properties: each write
                        goes to a version folder of its own, and a small pointer
                        file, written last, names the current one. Nothing is
                        renamed (a rename copies every byte on an object store)
                        and there is no moment without a table; row count
                        observed on the write itself (no second scan).
* ``ensure_table``     fingerprint-guarded build: skip when the stored
                        fingerprint equals the current one.
* ``input_identity``   path, size and time of every input file, aggregated by a
                        Spark job, so that changed inputs make another
                        fingerprint; ``code_version`` does so for the code.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir



def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: lineage is cut, the result survives executor loss, and (unlike an
    RDD checkpoint of an uncached plan) the plan runs exactly once."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/materialized/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_by_series(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for rows of (series, date) that lie by series, as those derived from a table clustered by it do: kept in
    that layout, so that windows over the result need neither an exchange nor a sort. The sort below costs nothing where Spark
    knows the rows' order."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/materialized/{name}-{uuid.uuid4().hex[:12]}"
    # a partitioning that is the rows' own adds no exchange
    rows = df.repartition(bucket_count(spark), "series").sortWithinPartitions("series", "date")
    write_table(rows, path, cluster_by="series", sort_by="date", laid=True)
    return read_table(spark, path)


# -- filesystem helpers (Hadoop FileSystem: works for local, HDFS, object stores) --
def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# -- SC4 + SC13 -----------------------------------------------------------------
POINTER = "_current.json"
#: Lets Spark rely on a bucket's order where the bucket is one file (it looks for itself).
ORDERED_SCANS = "spark.sql.legacy.bucketedTableScan.outputOrdering"
#: With open files for several buckets allowed, Spark does not sort a write by bucket; a laid out task has one bucket.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def bucket_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def _as_they_come(spark: SparkSession, laid: bool):
    before = spark.conf.get(OPEN_FILES)
    if laid:
        spark.conf.set(OPEN_FILES, "2")
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def write_table(df: DataFrame, path: str, properties: dict[str, str] | None = None, partition_by: tuple[str, ...] = (),
                labels: dict[str, str] | None = None, description: str | None = None, observed: dict[str, Column] | None = None,
                cluster_by: str | None = None, sort_by: str | None = None, laid: bool = False) -> int:
    """Write ``df`` as the new current version of the table at ``path``; returns the row count observed during the write.
    A destination that is also the source is read to its end before the pointer moves, and a failed write leaves the old
    version current. The version before stays for readers under way; older ones go.

    ``observed`` aggregates are taken during the write and kept as text properties. With ``cluster_by`` the rows are bucketed
    by that column and sorted by it and ``sort_by``: who groups, joins or ranks by them reads the table without an exchange or a
    sort. ``laid`` says that the rows lie so already (``bucket_count`` partitions by ``cluster_by``, each in that order): they are
    written as they come, neither shuffled nor sorted again."""
    spark = df.sparkSession
    base = path.rstrip("/")
    before = _pointer(spark, base)
    version = f"v-{uuid.uuid4().hex[:12]}"
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    n = bucket_count(spark)
    if cluster_by and not laid:
        df = df.repartition(n, cluster_by)  # below the observation: Spark drops one that lies under an exchange without rows
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.cast("string").alias(k) for k, c in (observed or {}).items()])
    buckets = None
    if cluster_by:
        name = f"t_{uuid.uuid4().hex}"
        order = [cluster_by, *([sort_by] if sort_by else [])]
        w = df.write.bucketBy(n, cluster_by)
        w = w if laid else w.sortBy(*order)
        with _as_they_come(spark, laid):
            w.option("path", f"{base}/{version}").saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # external: the files stay
        # a bucketed table without rows has no file that would tell its columns
        buckets = {"by": cluster_by, "sort": order, "n": n, "columns": [[f.name, f.dataType.simpleString()] for f in df.schema.fields]}
    else:
        w = df.write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{base}/{version}")
    seen = obs.get
    rows = int(seen["rows"])
    record = {
        "version": version, "previous": before.get("version"), "rows": rows, "labels": labels or {}, "buckets": buckets,
        "description": description, "properties": {**(properties or {}), **{k: seen[k] for k in observed or {}}},
    }
    _write_text(spark, f"{base}/{POINTER}", json.dumps(record, sort_keys=True))
    if before.get("previous"):
        _delete(spark, f"{base}/{before['previous']}")
    return rows


def _pointer(spark: SparkSession, path: str) -> dict:
    text = _read_text(spark, f"{path.rstrip('/')}/{POINTER}")
    return json.loads(text) if text else {}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table's current version; a clustered one with its buckets, so that Spark knows how its rows lie."""
    pointer = _pointer(spark, path)
    if "version" not in pointer:
        raise FileNotFoundError(f"no table at {path}")
    files = f"{path.rstrip('/')}/{pointer['version']}"
    buckets = pointer.get("buckets")
    if not buckets:
        return spark.read.parquet(files)
    known = buckets.get("columns") or [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(files).schema.fields]
    columns = ", ".join(f"`{name}` {kind}" for name, kind in known)
    ordered = " SORTED BY (" + ", ".join(f"`{c}`" for c in buckets["sort"]) + ")"
    spark.conf.set(ORDERED_SCANS, "true")
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{buckets['by']}`){ordered} INTO {buckets['n']} BUCKETS LOCATION '{files}'"
    )
    found = spark.table(name)
    found.schema  # resolved: the plan holds the files, the name is not needed any more
    spark.sql(f"DROP TABLE {name}")
    return found


def table_properties(spark: SparkSession, path: str) -> dict:
    """The properties of the current version, with its rows, labels and description."""
    p = _pointer(spark, path)
    return {**p.get("properties", {}), **{k: p[k] for k in ("rows", "labels", "description") if k in p}}


# -- TB5 --------------------------------------------------------------------
def input_identity(spark: SparkSession, *paths: str) -> str:
    """Number, bytes and a combined hash of path, size and time of every file below ``paths``: one Spark job over the listing
    (no content is read), whatever the number of files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(list(paths))
    one = files.agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("hash")
    ).first()
    return f"{one['n']}:{one['bytes']}:{one['hash']}"


def code_version(*modules) -> str:
    """A hash of the modules' sources: a table built by other code is another table."""
    return hashlib.sha256("".join(inspect.getsource(m) for m in modules).encode()).hexdigest()[:16]


def stored_fingerprint(spark: SparkSession, path: str) -> str | None:
    return table_properties(spark, path).get("fingerprint")


def ensure_table(spark: SparkSession, path: str, fingerprint: str, build, force: bool = False, **layout) -> tuple[DataFrame, bool]:
    """(table, rebuilt?): rebuild when the table is missing, stale or forced.

    The fingerprint is stored with the pointer, which is written last, so a
    partial write never looks current. ``layout`` goes to ``write_table``.
    """
    if not force and stored_fingerprint(spark, path) == fingerprint:
        return read_table(spark, path), False
    write_table(build(), path, {"fingerprint": fingerprint}, **layout)
    return read_table(spark, path), True
