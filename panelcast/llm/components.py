"""Connected components of a link table by alternating large and small stars, as joins over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b) but the labels themselves: label is the least node reachable.

    Each round points every node's larger neighbours, then every node's smaller neighbours, at the least node seen; it ends
    when the edge table no longer changes. A hub's minimum is aggregated before the shuffle and joined back from a written
    table, so a hub's edges can be split between tasks.
    """
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    e = written(e, "edges")
    mark = None
    while True:
        new = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark or new[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
        mark = new
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u > v").distinct(), "large-edges")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        e = written(small.filter("u > v").distinct(), "small-edges")
