"""Exact duplicates by Grace hashing (operator 11).

1. Each task merges the copies that it meets in an open-addressing table of bounded size, so that a text held by a third of
   all rows leaves a task a few times and not once a row.
2. The merged records are partitioned by a digit of their content's hash into spill files: a table bucketed by that digit in
   the shared folder. A bucket whose distinct contents exceed ``bucket_bytes`` is partitioned again by the next digit, until
   each bucket fits or holds one hash only (which no digit can split).
3. One task a bucket streams its records through an open-addressing table that compares complete contents: equal hashes alone
   never make a group. It leaves a row per distinct text: digest, number of rows, greatest id.
4. Rows find their group by the digest of the whole text. Groups of at least a ``HOT``-th of all rows (there are at most
   ``HOT`` of them, whatever the input) are broadcast, so no key of the other join has more rows than that.

Defined cases: a null text counts as empty; a null id is less than every other; of rows that repeat id and text one stays;
an empty table gives an empty result; further columns are not looked at. Memory: ``combine_bytes`` or ``bucket_bytes`` of
contents a task, plus one Arrow batch.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelcast.session import shared_path

from .common import prepare, written

#: Contents that a bucket's table may hold, and that a task gathers before it hands them on.
BUCKET_BYTES, COMBINE_BYTES = 64 << 20, 16 << 20
#: Spill files of one partitioning, and digits for each file (several a file even out their sizes).
MAX_FILES, DIGITS = 1024, 4
HOT = 10_000

RECORD = pa.schema([("h", pa.int64()), ("body", pa.binary()), ("n", pa.int64()), ("best", pa.int64())])
GROUP = pa.schema([("sha", pa.string()), ("group_size", pa.int64()), ("keep_id", pa.int64())])


class ContentTable:
    """Open addressing with linear probing. A slot holds the number of an entry; an entry is found only if its hash and its
    whole content are equal."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.bodies: list[bytes] = []
        self.sizes: list[int] = []
        self.best: list[int | None] = []
        self.held = 0

    def add(self, h: int, body: bytes, n: int, best: int | None) -> None:
        mask, slots = len(self.slots) - 1, self.slots
        at = h & mask
        while (k := slots[at]) >= 0:
            if self.hashes[k] == h and self.bodies[k] == body:
                self.sizes[k] += n
                if best is not None and (self.best[k] is None or best > self.best[k]):
                    self.best[k] = best
                return
            at = (at + 1) & mask
        slots[at] = len(self.bodies)
        self.hashes.append(h)
        self.bodies.append(body)
        self.sizes.append(n)
        self.best.append(best)
        self.held += len(body) + 64
        if 2 * len(self.bodies) > len(slots):
            self._grow()

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        slots = [-1] * (mask + 1)
        for k, h in enumerate(self.hashes):
            at = h & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = k
        self.slots = slots

    def records(self) -> Iterator[pa.RecordBatch]:
        """The entries, in batches of some MB."""
        start = 0
        while start < len(self.bodies):
            end, size = start, 0
            while end < len(self.bodies) and size < 4 << 20:
                size += len(self.bodies[end])
                end += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[start:end], f.type) for x, f in zip((self.hashes, self.bodies, self.sizes, self.best), RECORD, strict=True)],
                schema=RECORD,
            )
            start = end


def content_hash(body: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(body)
    return h - (1 << 64) if h >> 63 else h


def _combine(limit: int, hash_of: Callable[[bytes], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                table.add(hash_of(body), body, 1, doc_id)
                if table.held > limit:
                    yield from table.records()
                    table = ContentTable()
        yield from table.records()

    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = ContentTable()
    for batch in batches:
        for record in zip(*(batch.column(c).to_pylist() for c in ("h", "body", "n", "best")), strict=True):
            table.add(*record)
    digests = [hashlib.sha256(b).hexdigest() for b in table.bodies]
    yield pa.RecordBatch.from_arrays(
        [pa.array(x, f.type) for x, f in zip((digests, table.sizes, table.best), GROUP, strict=True)], schema=GROUP
    )


def _spill(records: DataFrame, files: int) -> DataFrame:
    """Write ``records`` as a table bucketed by ``bucket``: a task that reads a bucket needs no shuffle."""
    spark, name = records.sparkSession, f"spill_{uuid.uuid4().hex}"
    (
        records.repartition(files, "bucket").write.bucketBy(files, "bucket")
        .option("path", shared_path(spark, "llm", name)).option("compression", "zstd").saveAsTable(name)
    )
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
    return found


def contents(docs: DataFrame, text: Column, n_bytes: int, bucket_bytes: int = BUCKET_BYTES, combine_bytes: int = COMBINE_BYTES,
             max_files: int = MAX_FILES, hash_of: Callable[[bytes], int] = content_hash) -> DataFrame:
    """A row per distinct text: ``sha``, ``group_size``, ``keep_id``. ``n_bytes`` sizes the first partitioning only."""

    def files_for(size: float) -> int:
        return max(1, min(max_files, math.ceil(4 * size / bucket_bytes)))

    records = docs.select("doc_id", text.cast("binary").alias("body")).mapInArrow(
        _combine(combine_bytes, hash_of), "h long, body binary, n long, best long"
    )
    files, level, found = files_for(n_bytes), 0, []
    records = records.withColumn("bucket", F.lit(0).cast("long"))
    while True:
        digit = F.pmod(F.xxhash64("h", F.lit(level)), F.lit(DIGITS * files))
        spilled = _spill(records.withColumn("bucket", F.col("bucket") * (DIGITS * files) + digit), files)
        sizes = (
            spilled.groupBy("bucket", "h").agg(F.max(F.octet_length("body") + 64).alias("size"))
            .groupBy("bucket").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("hashes"))
        )
        large = sizes.filter((F.col("size") > bucket_bytes) & (F.col("hashes") > 1)).select("bucket", "size")
        most, total = large.agg(F.max("size"), F.sum("size")).first()
        here = spilled if most is None else spilled.join(large, "bucket", "left_anti")
        found.append(here.groupBy("bucket").applyInArrow(_resolve, "sha string, group_size long, keep_id long"))
        if most is None:
            break
        records = spilled.join(large, "bucket", "left_semi").select(*records.columns)
        files, level = max(2, files_for(total)), level + 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return written(out, "contents")


def groups(docs: DataFrame, normalise: Callable[[Column], Column] = lambda c: c, row: str | None = None, hot: int = HOT,
           **limits) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (the greatest id among equal texts), group_size, kept, text_sha256. ``row``
    names a column that already numbers the rows; the result then has it too."""
    spark = docs.sparkSession
    prepare(spark)
    text = normalise(F.coalesce(F.col("text"), F.lit("")))
    number = F.col(row) if row else F.monotonically_increasing_id()
    seen = Observation(f"grace_{uuid.uuid4().hex[:8]}")
    rows = written(
        docs.select(number.alias("row"), "doc_id", text.alias("text"))
        .observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
        .select("row", "doc_id", F.sha2("text", 256).alias("sha")),
        "rows",
    )
    n_rows = seen.get["rows"]
    found = contents(docs, text, seen.get["bytes"] or 0, **limits)
    is_hot = F.col("group_size") * hot >= n_rows
    marked = rows.join(F.broadcast(found.filter(is_hot)), "sha", "left")
    frequent = marked.filter("group_size IS NOT NULL")
    others = marked.filter("group_size IS NULL").select(rows.columns).join(found.filter(~is_hot), "sha")
    matched = frequent.unionByName(others)
    stays = matched.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("sha").agg(F.min("row").alias("row"))
    result = matched.join(stays.select("row", F.lit(True).alias("kept")), "row", "left").select(
        "row", "doc_id", "keep_id", "group_size", F.coalesce("kept", F.lit(False)).alias("kept"), F.col("sha").alias("text_sha256")
    )
    return result.withColumnRenamed("row", row) if row else result.drop("row")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one row for each text: of equal texts one with the greatest id. All columns stay."""
    spare = next(name for name in (f"row_{k}" for k in range(len(docs.columns) + 1)) if name not in docs.columns)
    numbered = written(docs.withColumn(spare, F.monotonically_increasing_id()), "numbered")
    kept = groups(numbered, row=spare, **options).filter("kept").select(spare)
    return numbered.join(kept, spare, "left_semi").select(*docs.columns)
