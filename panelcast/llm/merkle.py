"""A Merkle manifest of a dataset with inclusion proofs (operator 13).

``H`` is the lowercase hex SHA-256 of its inputs, concatenated (digests as hex text). A leaf is H of a row's fields, each '-'
if null, else its UTF-8 byte count, ':' and its value. Per group the leaves ascend by id; while more than one node remains,
each two consecutive nodes (the last run may be one) become their H. The groups' roots, null first and then bytewise by name,
give the root in the same way.

Method: places come from a range partitioning (rows of one group spread over tasks; ties by leaf and row number). A tree is
built in tiers of ``TIER`` levels: a block of 2**TIER consecutive nodes is a window partition, and at level k the row whose place
is a multiple of 2**k carries the node of its run. Its sibling is the row 2**k before or after it (fixed-offset ``lag`` and
``lead``, chosen by the slot's bit and masked by the run's length), and the first child's row hashes the parent. Blocks end in
one node each, the next tier's rows. No window holds more than 2**TIER rows, whatever a group's size.

Steps of a proof are text: 'L' or 'R' (side of the sibling) with its digest, '' for a run of one (the node alone is hashed);
levels at which the group has one node left have no step.

Defined cases: null fields as above; a null group is a group of its own; rows of equal id are ordered by leaf (equal leaves
are interchangeable); an empty table has no rows and no root; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TIER = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``place`` (from 0, by ``order``) and ``size`` (of the group ``g``). Sorted by range, so that a large group
    is many tasks' work; only counts by (range, group) meet in a window."""
    ranged = nodes.repartitionByRange("g", *order, "row").sortWithinPartitions("g", *order, "row")
    ranged = written(ranged.withColumn("i", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("i", 33)
    counts = ranged.groupBy("g", part.alias("part")).agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("g")
    counts = counts.select(
        "g", "part", "first", F.sum("n").over(group).alias("size"),
        (F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    found = ranged.withColumn("part", part).join(counts, ["g", "part"])
    return found.withColumn("place", F.col("before") + F.col("i") - F.col("first")).drop("part", "first", "before", "i")


def _tier(nodes: DataFrame, tier: int) -> DataFrame:
    """From (g, place, size, node): ``block``, ``steps`` (a row's own way up to its block's node) and, on the block's first row,
    the block's node ``top``."""
    df = nodes.withColumn("block", F.shiftright("place", tier)).withColumn("n0", F.col("node"))
    within = Window.partitionBy("g", "block").orderBy("place")
    count, grown = F.col("size"), []
    for k in range(tier):
        run, node, done = F.shiftright("place", k), f"n{k}", count <= 1
        right = F.pmod(run, F.lit(2)) == 1
        masked = F.when(right, F.lag(node, 1 << k).over(within)).when(run + 1 < count, F.lead(node, 1 << k).over(within))
        other = F.col(f"o{k}")
        parent = F.when(done, F.col(node)).when(other.isNull(), digest(F.col(node))).otherwise(digest(F.col(node), other))
        df = df.withColumn(f"o{k}", masked).withColumn(f"n{k + 1}", F.when(F.pmod("place", F.lit(2 << k)) == 0, parent))
        step = F.when(other.isNull(), F.lit("")).otherwise(F.concat(F.when(right, F.lit("L")).otherwise(F.lit("R")), other))
        carries = F.pmod("place", F.lit(1 << k)) == 0  # this row has its run's node, and hands the step on to the run's rows
        df = df.withColumn(f"s{k}", F.when(carries & ~done, step))
        grown.append(~done)
        count = F.shiftright(count + 1, 1)
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    steps = [F.when(more, F.last(f"s{k}", ignorenulls=True).over(so_far)) for k, more in enumerate(grown)]
    return df.select(*nodes.columns, "block", F.col(f"n{tier}").alias("top"), F.array_compact(F.array(*steps)).alias("steps"))


def _climb(nodes: DataFrame, tier: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of every group's tree over (g, place, size, node), and the groups' roots (g, node)."""
    tiers = []
    while True:
        tiers.append(written(_tier(nodes, tier), "tier"))
        above = tiers[-1].filter(F.col("top").isNotNull()).select(
            "g", F.col("block").alias("place"), F.shiftright(F.col("size") + ((1 << tier) - 1), tier).alias("size"), F.col("top").alias("node")
        )
        if (tiers[-1].agg(F.max("size")).first()[0] or 0) <= 1 << tier:
            return tiers, above.select("g", "node")
        nodes = above


def _descend(tiers: list[DataFrame], up: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The first tier's rows with all their steps: ``up`` has (g, block, steps) and the ``carried`` columns for each root. A key of
    these joins has at most 2**tier rows."""
    for here in reversed(tiers):
        more = up.select("g", "block", F.col("steps").alias("more"), *carried)
        found = here.drop("top").join(more, ["g", "block"]).withColumn("steps", F.concat("steps", "more")).drop("more", "block")
        up = found.withColumnRenamed("place", "block")
    return found


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps give."""
    return F.aggregate(
        steps, leaf,
        lambda node, s: F.sha2(F.when(F.substring(s, 1, 1) == "L", F.concat(F.substring(s, 2, 64), node)).otherwise(F.concat(node, F.substring(s, 2, 64))), 256),
    )


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group: str = "lang",
             altered: dict[str, Column] | None = None, where: Column | None = None, tier: int = TIER) -> DataFrame:
    """Per row: id, leaf, subroot, root, steps, proof_sha256, folded_root and verified. ``altered`` gives expressions for the
    fields of a copy that is verified against the original's siblings, in the rows that meet ``where`` (none: the original)."""
    own = digest(*[field(F.col(c)) for c in fields])
    leaves = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"), own.alias("node"),
        (F.when(where, digest(*[field(altered.get(c, F.col(c))) for c in fields])) if altered else F.lit(None).cast("string")).alias("held"),
    )
    tiers, subroots = _climb(placed(leaves, ["id", "node"]), tier)
    tops = subroots.select(F.lit("").alias("g"), F.lit(0).cast("long").alias("row"), F.col("g").alias("name"), "node")
    top_tiers, root = _climb(placed(tops, ["name"]), tier)  # root: one row, or none
    root = root.select("g", F.lit(0).cast("long").alias("block"), F.array().cast("array<string>").alias("steps"), F.col("node").alias("root"))
    trees = _descend(top_tiers, F.broadcast(root), ["root"]).select(
        F.col("name").alias("g"), F.lit(0).cast("long").alias("block"), "steps", F.col("node").alias("subroot"), "root"
    )
    return _descend(tiers, trees, ["subroot", "root"]).select(
        F.col("id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root", "steps",
        F.sha2(F.array_join(F.transform("steps", lambda s: F.substring(s, 2, 64)), ""), 256).alias("proof_sha256"),
        fold(F.coalesce("held", "node"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def report(docs: DataFrame, tier: int = TIER) -> DataFrame:
    """The manifest with n_chars raised by one where 7 divides the CRC-32 of the id's digits."""
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    return manifest(docs, altered={"n_chars": F.col("n_chars") + 1}, where=hit, tier=tier).drop("steps")
