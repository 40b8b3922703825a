"""Quality classifier on random-indexing word vectors (operator 5).

Every word (by a hash into ``BUCKETS`` buckets) has a sparse random index vector of ``NONZERO`` signs in ``DIM`` places. A
bucket's word vector is the sum of the index vectors of the words within two places of its occurrences, over the whole
texts of all documents: each task sums its own texts and hands on a row per bucket, Spark adds them up. The table has
BUCKETS rows at any corpus size, which bounds the broadcast (8 MB).

A document is pooled to the mean and the standard deviation of its words' vectors; a network of two layers (numpy, Adam)
trained on at most ``MAX_TRAIN`` labelled training documents gives its logit, and a temperature fitted to a part of them
that the network didn't see turns it into a probability. Only labels of training rows (crc32 of doc_id mod 4 is not 2) are
read; lang, source and doc_id are no inputs of a score.

Cases: null or empty text has no words and is pooled to zeros; repeated rows get equal scores; long texts are pooled whole;
without labelled rows of both classes every score is the share of the one class (0.5 without any); a null doc_id is never
trained on and counts as not held out; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_train, prepare, written

BUCKETS, DIM, NONZERO = 1 << 15, 64, 2
WINDOW = 2
MAX_TRAIN = 8_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 64, 3e-3, 1e-4
THRESHOLD = 0.7
#: Words accumulated at once.
CHUNK = 400_000

_rng = np.random.Generator(np.random.PCG64(5))
_DIMS = _rng.integers(0, DIM, (NONZERO, BUCKETS)).astype(np.int64)
_SIGNS = _rng.choice(np.array([-1.0, 1.0]), (NONZERO, BUCKETS))


class Buckets(dict):
    """Bucket of each word; forgets all words when it holds 300,000."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        b = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)
        return b


def buckets_of(text: str | None, memo: Buckets) -> np.ndarray:
    return np.array([memo[w] for w in text.split()] if text else [], np.int64)


def _add(table: np.ndarray, docs: list[np.ndarray]) -> None:
    """Add the index vectors of near words to the rows of ``table``."""
    ids = np.concatenate(docs)
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    for gap in range(1, WINDOW + 1):
        same = doc[gap:] == doc[:-gap]
        a, b = ids[:-gap][same], ids[gap:][same]
        for x, y in ((a, b), (b, a)):
            for k in range(NONZERO):
                table += np.bincount(x * DIM + _DIMS[k][y], weights=_SIGNS[k][y], minlength=BUCKETS * DIM)


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, memo = np.zeros(BUCKETS * DIM), Buckets()
    held, n = [], 0
    for b in batches:
        for text in b.column("text").to_pylist():
            d = buckets_of(text, memo)
            held.append(d)
            n += len(d)
            if n >= CHUNK:
                _add(table, held)
                held, n = [], 0
    if held:
        _add(table, held)
    rows = table.reshape(BUCKETS, DIM).astype(np.int64)
    used = np.flatnonzero(rows.any(axis=1))
    for i in range(0, len(used), 4096):
        at = used[i : i + 4096]
        columns = [pa.array(at.astype(np.int32)), *[pa.array(np.ascontiguousarray(rows[at, c])) for c in range(DIM)]]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *[f"c{c}" for c in range(DIM)]])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The BUCKETS x DIM table of context vectors over all texts, centred and of length one."""
    names = [f"c{c}" for c in range(DIM)]
    schema = "bucket int, " + ", ".join(f"{c} long" for c in names)
    parts = docs.select("text").mapInArrow(_context_sums, schema)
    got = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).toArrow()  # BUCKETS rows at most
    table = np.zeros((BUCKETS, DIM), np.float32)
    table[got.column("bucket").to_numpy()] = np.stack([got.column(c).to_numpy() for c in names], axis=1)
    size = np.linalg.norm(table, axis=1, keepdims=True)
    table = np.divide(table, size, out=np.zeros_like(table), where=size > 0)
    if len(got):
        table[size[:, 0] > 0] -= table[size[:, 0] > 0].mean(axis=0)
    return table


def pooled(text: str | None, table: np.ndarray, memo: Buckets) -> np.ndarray:
    """Mean and standard deviation of the words' vectors."""
    ids, n = np.unique(buckets_of(text, memo), return_counts=True)
    if not len(ids):
        return np.zeros(2 * DIM, np.float32)
    v, share = table[ids], (n / n.sum()).astype(np.float32)
    mean = share @ v
    return np.concatenate([mean, np.sqrt(np.maximum(share @ (v * v) - mean * mean, 0))])


class Network:
    """Two layers with a rectifier between, trained by Adam on the logistic loss; then a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 1):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 1e-6
        order = rng.permutation(len(x))
        cut = max(1, len(x) // 5)
        x = (x - self.mean) / self.std
        calibrate, train = order[:cut], order[cut:] if len(x) > 1 else order
        d = x.shape[1]
        p = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.array(0.0)]
        m, s, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(EPOCHS):
            rng.shuffle(train)
            for i in range(0, len(train), BATCH):
                at = train[i : i + BATCH]
                xb = x[at]
                h = np.maximum(xb @ p[0] + p[1], 0)
                e = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - y[at]) / len(at)
                back = np.outer(e, p[2]) * (h > 0)
                grads = [xb.T @ back + DECAY * p[0], back.sum(axis=0), h.T @ e + DECAY * p[2], e.sum()]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
        self.p, self.temperature = p, 1.0
        z, t = self.logits(x[calibrate], scaled=True), y[calibrate]
        loss = lambda a: np.mean(np.logaddexp(0, -(2 * t - 1) * z / a))
        self.temperature = float(min(np.geomspace(0.5, 20, 80), key=loss))

    def logits(self, x: np.ndarray, scaled: bool = False) -> np.ndarray:
        x = x if scaled else (x - self.mean) / self.std
        return np.maximum(x @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _training(docs: DataFrame, labels: DataFrame, sent) -> tuple[np.ndarray, np.ndarray]:
    y = labels.filter(in_train(F.col("doc_id")) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    y = y.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("y"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Buckets()
        for b in batches:
            f = [pooled(t, sent.value, memo) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(f, pa.list_(pa.float32())), b.column("y")], ["doc_id", "f", "y"])

    rows = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id").mapInArrow(run, "doc_id long, f array<float>, y int")
    got = rows.toArrow().sort_by("doc_id")  # repeated documents count as often as they occur
    f = got.column("f").combine_chunks().values.to_numpy().reshape(-1, 2 * DIM) if len(got) else np.zeros((0, 2 * DIM), np.float32)
    return f.astype(np.float64), got.column("y").to_numpy().astype(float)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    spark = docs.sparkSession
    prepare(spark)
    vectors = spark.sparkContext.broadcast(word_vectors(docs))
    x, y = _training(docs, labels, vectors)
    both = len(y) and 0 < y.sum() < len(y)
    net = spark.sparkContext.broadcast(Network(x, y) if both else None)
    flat = float(y.mean()) if len(y) else 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n, memo = vectors.value, net.value, Buckets()
        for b in batches:
            f = np.array([pooled(t, table, memo) for t in b.column("text").to_pylist()]).reshape(-1, 2 * DIM)
            s = n.probability(f) if n else np.full(len(f), flat)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s.astype(np.float64))], ["doc_id", "score"])

    d = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(~in_train(F.col("doc_id")), F.lit(False))
    return d.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
