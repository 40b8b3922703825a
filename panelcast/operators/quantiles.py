"""Exact grouped quantiles of columns too long for one task.

``grouped_quantiles``: a rank sketch (Spark's mergeable ``percentile_approx``) sets each group's range limits by rank, so that
heavy tails can't gather the values in a few ranges. Values are counted by range; a value equal to a limit has a range of its
own, so a value that a third of all rows share is counted and never sorted. Only the ranges that hold a wanted rank are then
sorted, a small share of the rows, and picked from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of a group: the fullest holds some 1 / RANGES of its rows.
RANGES = 512


def _place(limits: dict[tuple, np.ndarray], keys: Sequence[str]):
    """The range of each value: 2 i + 1 for limit i itself, 2 i for what lies below it (and above limit i - 1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.zeros(len(pdf), np.int32)
            for key, at in pdf.groupby(list(keys), sort=False).indices.items():
                edges = limits[key if isinstance(key, tuple) else (key,)]
                v = pdf["r"].to_numpy()[at]
                i = np.searchsorted(edges, v, side="left")
                exact = (i < len(edges)) & (edges[np.minimum(i, len(edges) - 1)] == v)
                out[at] = 2 * i + exact
            yield pdf.assign(bin=out)

    return run


def placed(df: DataFrame, keys: Sequence[str], value: str, ranges: int = RANGES) -> DataFrame:
    """(*keys, r, bin): every value with its range."""
    rows = df.select(*keys, F.col(value).cast("double").alias("r")).where("r IS NOT NULL")
    grid = [float(p) for p in np.linspace(0, 1, ranges + 1)]
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("r", grid, 20 * ranges).alias("edges"))
    limits = {tuple(r[:-1]): np.unique(np.asarray(r["edges"], float)) for r in sketch.collect()}
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(_place(limits, keys), f"{types}, bin int")


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, levels: Sequence[float], ranges: int = RANGES) -> DataFrame:
    """(*keys, quantiles): linearly interpolated between the ranks around (m - 1) * level. NULLs don't count. The groups are few
    (steps, levels): ``ranges`` doubles a group are held at the driver."""
    keys = list(keys)
    rows = placed(df, keys, value, ranges)
    sizes = rows.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("size"))
    ordered = Window.partitionBy(*keys).orderBy("bin")  # at most 2 * ranges + 1 rows a group
    before = F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    sizes = sizes.select("*", before.alias("before"), F.sum("size").over(Window.partitionBy(*keys)).alias("m"))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(levels)])
    ranks = sizes.select("*", F.explode(wanted).alias("w")).withColumn("pos", (F.col("m") - 1) * F.col("w.q"))
    ranks = ranks.withColumn("lo", F.floor("pos")).withColumn("hi", F.least(F.col("lo") + 1, F.col("m") - 1))
    holds = lambda k: (F.col(k) >= F.col("before")) & (F.col(k) < F.col("before") + F.col("size"))
    ranks = ranks.where(holds("lo") | holds("hi")).select(*keys, "bin", "before", "w.i", "lo", "hi", (F.col("pos") - F.col("lo")).alias("part"))
    # two ranges a group and level at most: their rows by value, counted before they are sorted
    near = rows.join(F.broadcast(ranks.select(*keys, "bin").distinct()), [*keys, "bin"], "left_semi")
    near = near.groupBy(*keys, "bin", "r").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*keys, "bin").orderBy("r"))
    hit = near.withColumn("upto", upto).join(F.broadcast(ranks), [*keys, "bin"])
    first, last = F.col("before") + F.col("upto") - F.col("c"), F.col("before") + F.col("upto") - 1
    share = lambda k, w: F.sum(F.when(F.col(k).between(first, last), F.col("r") * w))
    found = hit.groupBy(*keys, "i").agg((share("lo", 1 - F.col("part")) + share("hi", F.col("part"))).alias("v"))
    return found.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("quantiles"))
