"""Fits over whole series in one pass: rows that lie by series and day come to Python as Arrow batches, are cut into chunks of whole
series, and every sum by series is a ``reduceat`` over the chunk, whatever the length of its series. Over the stored panel (bucketed
by series, in order of series and day) no row is shuffled, sorted or written. A task holds a chunk: ``ROWS`` rows, or one series
where that is longer (a row a day).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Spark's limit on a batch's bytes, for which it adds up the bytes of every column at every row; at the largest value it does not.
#: Rows limit a batch too (``spark.sql.execution.arrow.maxRecordsPerBatch``).
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows of a chunk (arrays that stay in a core's cache), and series whose models are solved together.
ROWS, SERIES = 1 << 16, 256


def laid(frame: DataFrame) -> DataFrame:
    """``frame`` (series, date, ...) by series and day, with the series' name on its first day only. The window asks for whole series
    in that order, and over the stored panel has them at no exchange and no sort; a plain repartition and sort would be dropped there
    as already met, and the scan's buckets after them as not asked for, which splits a series where a file is split."""
    by_time = Window.partitionBy("series").orderBy("date")
    rest = [c for c in frame.columns if c != "series"]
    return frame.where(F.col("series").isNotNull()).select(F.when(F.row_number().over(by_time) == 1, F.col("series")).alias("series"), *rest)


def _starts(table: pa.Table) -> np.ndarray:
    return np.flatnonzero(table.column("series").is_valid().to_numpy())


class Chunk:
    """Rows of whole series: ``series`` (one value each), ``start``, ``length`` and ``last`` (its last row), ``at`` (a row's place in
    its series)."""

    def __init__(self, table: pa.Table):
        self.table = table.combine_chunks()
        self.start = _starts(self.table)
        self.series = self.table.column("series").chunk(0).take(pa.array(self.start))
        self.length = np.diff(self.start, append=len(self.table))
        self.last = self.start + self.length - 1
        self.at = np.arange(len(self.table)) - np.repeat(self.start, self.length)

    def column(self, name: str) -> tuple[np.ndarray, np.ndarray | None]:
        """Values (0 where unknown) and which are known (None: all)."""
        col = self.table.column(name).chunk(0)
        if not col.null_count:
            return col.to_numpy(zero_copy_only=False), None
        return col.fill_null(0).to_numpy(zero_copy_only=False), col.is_valid().to_numpy(zero_copy_only=False)

    def days(self) -> np.ndarray:
        return self.table.column("date").chunk(0).cast(pa.int32()).to_numpy()

    def sums(self, v: np.ndarray) -> np.ndarray:
        return np.add.reduceat(v, self.start)

    def rows(self, v: np.ndarray) -> np.ndarray:
        """A series' value on each of its rows."""
        return np.repeat(v, self.length)

    def running(self, v: np.ndarray) -> np.ndarray:
        """Cumulative sums by series (each its own, so that a series' size does not cost another its digits)."""
        out = np.empty_like(v)
        for a, z in zip(self.start, self.last + 1, strict=True):
            np.cumsum(v[a:z], out=out[a:z])
        return out

    def tail(self, v: np.ndarray, k: int) -> np.ndarray:
        """The last ``k`` values of each series, newest first, 0 before its first row."""
        back = np.arange(k)
        return np.where(back < self.length[:, None], v[np.maximum(self.last[:, None] - back, 0)], 0.0)

    def gram(self, vs: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By series the sums of v_i v_j and v_i y."""
        k = len(vs)
        g, b, product = np.empty((len(self.start), k, k)), np.empty((len(self.start), k)), np.empty(len(y))
        for i in range(k):
            for j in range(i, k):
                g[:, i, j] = g[:, j, i] = self.sums(np.multiply(vs[i], vs[j], out=product))
            b[:, i] = self.sums(np.multiply(vs[i], y, out=product))
        return g, b


def lag(v: np.ndarray, k: int, unknown: np.ndarray) -> np.ndarray:
    """``v`` of ``k`` rows before, 0 on the rows ``unknown`` (which cover those whose series has no such row)."""
    out = np.zeros_like(v)
    out[k:] = v[:-k]
    out[unknown] = 0.0
    return out


def dot(vs: list[np.ndarray], c: np.ndarray, chunk: Chunk) -> np.ndarray:
    """Sum of v_i times its series' c_i."""
    out = np.zeros(len(vs[0]))
    for i, v in enumerate(vs):
        out += v * chunk.rows(c[:, i])
    return out


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    held, n, enough = [], 0, ROWS
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        table = pa.Table.from_batches(held)
        whole = int(_starts(table)[-1])
        if whole:
            yield Chunk(table.slice(0, whole))
        rest = table.slice(whole).combine_chunks()  # of its own, so that the chunk's rows are freed
        held, n = rest.to_batches(), len(rest)
        enough = max(ROWS, 2 * n)
    if n:
        yield Chunk(pa.Table.from_batches(held))


def regression(chunk: Chunk, columns: list[str], solve: Callable) -> tuple[dict, np.ndarray]:
    """(series, last_date, n, mu and beta by series, errors by row) of ``y`` on [1, columns], an unknown value being its series'
    mean; ``solve`` of a series' Gram, right side and number of rows gives beta."""
    y = chunk.column("y")[0]
    mu, xs = np.zeros((len(chunk.start), len(columns))), [np.ones(len(y))]
    for i, c in enumerate(columns):
        v, known = chunk.column(c)
        n = chunk.length if known is None else chunk.sums(known.astype(np.int64))
        mu[:, i] = np.where(n > 0, chunk.sums(v) / np.maximum(n, 1), 0.0)
        xs.append(v if known is None else np.where(known, v, chunk.rows(mu[:, i])))
    g, b = chunk.gram(xs, y)
    beta = np.array([solve(*one) for one in zip(g, b, chunk.length.tolist(), strict=True)])
    found = {
        "series": chunk.series, "last_date": chunk.table.column("date").chunk(0).take(pa.array(chunk.last)), "n": chunk.length, "mu": mu, "beta": beta,
    }
    return found, y - dot(xs, beta, chunk)


def record(found: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A row a series; a matrix is a column of arrays. What could not be calculated (NaN) is NULL."""

    def column(v, kind: pa.DataType) -> pa.Array:
        if isinstance(v, np.ndarray) and v.ndim == 2:
            return pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, v.shape[1]), pa.int32()), pa.array(np.ravel(v), from_pandas=True))
        return v.cast(kind) if isinstance(v, pa.Array) else pa.array(v, kind, from_pandas=True)

    return pa.RecordBatch.from_arrays([column(found[f.name], f.type) for f in schema], schema=schema)


def joined(parts: list[dict]) -> dict:
    one = lambda vs: pa.concat_arrays(vs) if isinstance(vs[0], pa.Array) else np.concatenate(vs)
    return {k: one([p[k] for p in parts]) for k in parts[0]}


def fitted(frame: DataFrame, schema: pa.Schema, ddl: str, sums: Callable[[Chunk], dict], solve: Callable[[dict], dict]) -> DataFrame:
    """A row per series of ``frame`` (series, date, y, ...): ``sums`` of each chunk by series, ``solve`` of many series' at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for chunk in chunks(batches):
            parts.append(sums(chunk))
            n += len(chunk.start)
            if n >= SERIES:
                yield record(solve(joined(parts)), schema)
                parts, n = [], 0
        if parts:
            yield record(solve(joined(parts)), schema)

    return laid(frame).mapInArrow(run, ddl)


@contextmanager
def _batches_by_rows(spark: SparkSession):
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(2**31 - 1))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def stored(model: DataFrame, path: str | None, name: str) -> DataFrame:
    """The model table, written once, to ``path`` where one is given and else to the shared folder, and read back."""
    from ...sources.tables import materialize

    spark = model.sparkSession
    with _batches_by_rows(spark):
        if path is None:
            return materialize(model, name)
        model.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
