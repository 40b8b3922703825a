"""Near-duplicate groups by one-permutation MinHash (operator 10).

A text's words (A-Z lower-cased) give a set of 5-word shingle hashes. One hash per shingle is enough for the sketch: its
high bits choose one of ``BINS`` bins and the least hash of a bin is the bin's value. Empty bins borrow from the non-empty
bin that comes first in a fixed random order of their own (optimal densification). ``ROWS`` bins make a band; equal bands
meet in a bucket.

* Equal sets are one node; copies are never expanded into pairs. Nodes are numbered by their least doc_id.
* Each bucket gives star-shaped candidate edges: from every member to the member with the least number. They are
  confirmed on the full sets, and confirmed links are joined into components. A bucket whose members then have one
  component is finished.
* The members of all other buckets go through an exact rest: a set-similarity join with prefix, length and position
  filters on shingles that occur in more than one component, rarest first. It finds every link between two such nodes of
  different components, so centres that are linked with nothing lose none. Within a group no list of all pairs is made.

With 40 bands of 6 bins a pair at the threshold shares no bucket with probability under 1e-5 (0.8) and 1e-8 (0.85).
Sets are compared by 64-bit shingle hashes; a node is known by a 64-bit hash of its sorted set.

Cases: a text without words, or null, has no shingles, is linked with nothing and stays; fewer words than five are one
shingle; repeated rows are copies (``deduplicate`` keeps one); of equal doc_ids each row keeps its own text's component; a
null doc_id is never a component's name unless the whole component has none; an empty table gives an empty result; other
columns are not read (``deduplicate`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import prepare, written
from .components import components

SHINGLE = 5
BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
THRESHOLD = 80

_rng = np.random.Generator(np.random.PCG64(20_240_521))
_odd = lambda n: _rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _odd(256)
_PLACE = _odd(SHINGLE + 1)
_BAND = _odd(ROWS)
_BASE = int(_odd(1)[0])
_ORDER = np.argsort(_rng.random((BINS, BINS)), axis=1).argsort(axis=1).astype(np.int16)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, from one pass over their joined bytes: differences of polynomial prefix sums."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    lengths = np.diff(ends, prepend=0)
    # powers restart at each word, so no inverse is needed: place of every byte within its word
    place = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
    power = _powers(int(lengths.max()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * power[place])])
    return _mix((sums[ends] - sums[ends - lengths]) * np.uint64(2) + lengths.astype(np.uint64))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, np.uint64(_BASE))]))
    return _POWERS


_POWERS = np.ones(1, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = _word_hashes(words)
    k = min(SHINGLE, len(w))
    n = len(w) - k + 1
    h = np.full(n, np.uint64(k) * _PLACE[SHINGLE])
    for j in range(k):
        h += w[j : j + n] * _PLACE[j]
    return np.unique(_mix(h))


def band_hashes(shingles: np.ndarray) -> np.ndarray:
    """The band hashes of a non-empty sorted set."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    full = bins[first].astype(np.int64)
    sig = np.zeros(BINS, np.uint64)
    sig[full] = shingles[first]  # sorted: a bin's first hash is its least
    if len(full) < BINS:
        empty = np.setdiff1d(np.arange(BINS), full, assume_unique=True)
        sig[empty] = sig[full[np.argmin(_ORDER[np.ix_(empty, full)], axis=1)]]
    bands = (_mix(sig.reshape(BANDS, ROWS)) * _BAND).sum(axis=1, dtype=np.uint64)
    return _mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_BASE)).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, key, bands = [], [], []
        for text in b.column("text").to_pylist():
            s = shingle_set(text)
            n.append(len(s))
            key.append(int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)) if len(s) else None)
            bands.append(band_hashes(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("th"), pa.array(n, pa.int64()), pa.array(key, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "th", "n", "key", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingle_set(t).view(np.int64) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(map(len, sets), pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "n", "shingles"])


def _confirm(threshold: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sa, sb = b.column("sa"), b.column("sb")
            keep = []
            for x, y in zip(sa, sb, strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold, as a written table."""
    a = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    near = 100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb")
    x = pairs.join(a, "a").join(b, "b").filter(near).select("a", "b", "sa", "sb")
    return written(x.mapInArrow(_confirm(threshold), "a long, b long"), "links")


def _ceil_div(x, d: int):
    return F.floor((x + (d - 1)) / d).cast("long")


def _rest_pairs(nodes: DataFrame, sets: DataFrame, t: int) -> DataFrame:
    """Candidate pairs (a, b) of ``nodes`` (node, label) with different labels: every pair at the threshold is among them."""
    rows = sets.join(nodes, "node").select("node", "label", "n", F.explode("shingles").alias("s"))
    spread = rows.groupBy("s").agg(F.count("*").alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    spread = written(spread.filter("lo < hi").select("s", "df"), "spread")
    own = W.partitionBy("node")
    common = rows.join(spread, "s").withColumn("c", F.count("*").over(own)).filter(100 * F.col("c") >= t * F.col("n"))
    # shingles of one component come first in the order and can't match: they only move the others' places
    place = F.col("n") - F.col("c") + F.row_number().over(own.orderBy("df", "s")) - 1
    common = common.withColumn("place", place).filter(F.col("place") <= F.col("n") - _ceil_div(t * F.col("n"), 100))
    common = written(common.select("node", "label", "n", "s", "place"), "prefixes")
    a = common.select(*[F.col(c).alias(f"a_{c}") for c in common.columns])
    b = common.filter(F.col("place") <= F.col("n") - _ceil_div(2 * t * F.col("n"), 100 + t))
    b = b.select(*[F.col(c).alias(f"b_{c}") for c in common.columns])
    larger = (F.col("b_n") < F.col("a_n")) | ((F.col("b_n") == F.col("a_n")) & (F.col("b_node") < F.col("a_node")))
    needed = _ceil_div(t * (F.col("a_n") + F.col("b_n")), 100 + t)
    most = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    on = (F.col("a_s") == F.col("b_s")) & (F.col("a_label") != F.col("b_label")) & larger & (100 * F.col("b_n") >= t * F.col("a_n")) & (most >= needed)
    return a.join(b, on).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    return nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _grouped(docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(sketches of all rows: doc_id, th, n, key), (key, label, component_id); component_ids may be null or shared, labels not."""
    prepare(docs.sparkSession)
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    rows = written(texts.mapInArrow(_sketch, "doc_id long, th long, n long, key long, bands array<long>"), "sketches")

    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("x")
    reps = rows.filter("n > 0").groupBy("key").agg(first, F.first("bands").alias("bands"))
    reps = reps.select("key", "x.doc_id", "x.th", "bands").orderBy(F.col("doc_id").asc_nulls_last(), "key")
    reps = written(reps.withColumn("node", F.monotonically_increasing_id()), "nodes")

    buckets = reps.select("node", F.explode("bands").alias("bucket"))
    stars = buckets.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last")).filter("centre < last")
    stars = written(stars.select("bucket", "centre"), "stars")
    members = written(buckets.join(stars, "bucket"), "members")

    wanted = members.select("node").distinct().join(reps.select("node", F.col("doc_id").alias("id"), F.col("th").alias("key_th")), "node")
    same = (F.col("th") == F.col("key_th")) & F.col("doc_id").eqNullSafe(F.col("id"))
    sets = texts.join(wanted, same).select("node", "text").mapInArrow(_sets, "node long, n long, shingles array<long>")
    sets = written(sets, "sets")

    edges = members.filter("node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    links = _confirmed(edges, sets, threshold)
    labels = components(links)

    # buckets that still hold more than one component
    named = written(_labelled(members.select("bucket", "node"), labels), "named")
    open_ = named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    open_ = written(open_.select("bucket"), "open-buckets")
    rest = written(named.join(open_, "bucket").select("node", "label").distinct(), "rest")
    more = _confirmed(_rest_pairs(rest, sets.dropDuplicates(["node"]), threshold), sets, threshold)
    labels = written(components(links.unionByName(more)), "labels")

    full = _labelled(reps.select("node", "key", "doc_id"), labels)
    names = written(full.groupBy("label").agg(F.min("doc_id").alias("component_id")), "names")
    return rows, written(full.join(names, "label").select("key", "label", "component_id"), "components")


def groups(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document; ``threshold`` is the similarity in percent."""
    rows, named = _grouped(docs, threshold)
    name = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    d = rows.select("doc_id", "n", "key").join(named, "key", "left").withColumn("name", name)
    return d.select("doc_id", F.col("n").alias("n_shingles"), F.col("name").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("name")).alias("kept"))


def deduplicate(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each group, with all its columns: the one with the least doc_id."""
    rows, named = _grouped(docs.select("doc_id", "text"), threshold)
    d = rows.filter("n > 0").select("doc_id", "th", "key").join(named, "key")
    d = written(d.groupBy("label", "doc_id", "th").agg(F.count("*").alias("copies")), "group-members")
    # one row's key per group: the least doc_id, then the least text hash
    best = d.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("x"))
    best = written(best, "kept")
    kept = d.join(best, "label")
    is_best = (F.col("th") == F.col("x.th")) & F.col("doc_id").eqNullSafe(F.col("x.doc_id"))
    out = written(kept.filter(~is_best).select(F.col("th").alias("__llm_th"), F.col("doc_id").alias("__llm_id")).distinct(), "dropped")
    twice = written(kept.filter(is_best & (F.col("copies") > 1)).select(F.col("th").alias("__llm_th"), F.col("doc_id").alias("__llm_id")).distinct(), "repeated")
    keyed = docs.withColumn("__llm_key", F.xxhash64("text"))
    on = lambda t: (F.col("__llm_key") == t["__llm_th"]) & F.col("doc_id").eqNullSafe(t["__llm_id"])
    keyed = keyed.join(out, on(out), "left_anti")
    single = keyed.join(twice, on(twice), "left_anti").select(*docs.columns)
    if not twice.take(1):
        return keyed.select(*docs.columns)
    again = keyed.join(twice, on(twice), "left_semi").dropDuplicates(["doc_id", "__llm_key"]).select(*docs.columns)
    return single.unionByName(again)
