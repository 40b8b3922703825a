"""Quotation linking in conversations (operator 3), in DataFrame functions only.

A message's lines are split by their quote level (the number of leading ``>`` signs; blanks between them are allowed). Runs
of lines of one level are passages; a passage is normalised (quote signs off, letters and digits only, lower-cased, one
blank between words) and hashed, however short it is; one without letters and digits is no passage. A message's own text is its lines of level 0 without attribution lines ("... wrote:"
before a quote).

Originals are indexed by conversation and hash: the whole own text, each own passage and each own line, with the earliest
turn that has it (aggregated before the shuffle, so a line that a third of all messages share is one row per task). A
message's quoted passages, and their single lines, are joined to this index on conversation and hash; a link needs an
earlier turn. The parent is the original of the shallowest quoted passage, then of the longest, then the earliest. Nobody
is linked by pairs: each quoted passage meets one indexed row.

Threads: the root of each message comes from following parents, doubling the reach each round (a written table per round).
Reply order sorts a conversation by (turn of the thread's root, turn): each thread stands together and a reply comes after
what it quotes. Positions are counted by blocks of turns, so that a conversation with a third of all messages is numbered by
many tasks.

Cases: null or empty text has an empty body and no quotes; a null turn can neither be quoted nor order by anything but its
place at the front; rows of a null conversation are one conversation; repeated rows get equal parents and neighbouring
positions; turns with equal numbers are ordered by role and text; long texts are parsed whole; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import prepare, written

QUOTE = r"^(?:[ \t]*>)+ ?"
ATTRIBUTION = r"(?i)^\s*(on\b.*|.*\S) (wrote|schrieb|écrit|escribió) ?:\s*$"
#: Turns in one block of the numbering.
BLOCK = 256


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _lines(messages: DataFrame) -> DataFrame:
    """(id, lines): each line as (level, text, run), where a run is a row of lines of one level without a blank line."""
    level = lambda x: F.char_length(F.regexp_replace(F.regexp_extract(x, QUOTE, 0), "[^>]", ""))
    parsed = F.transform(F.split(F.coalesce("text", F.lit("")), "\r?\n", -1), lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, QUOTE, "").alias("line")))
    d = messages.select("id", "conv_id", "turn", parsed.alias("parsed"))
    nxt = lambda i: F.get(F.col("parsed"), i + 1)["level"]
    said = lambda x, i: (x["level"] == 0) & x["line"].rlike(ATTRIBUTION) & (F.coalesce(nxt(i), F.lit(0)) > 0)
    kept = F.filter("parsed", lambda x, i: ~said(x, i))
    return d.select("id", "conv_id", "turn", kept.alias("lines"))


def _passages(lines: DataFrame) -> DataFrame:
    """(id, conv_id, turn, level, kind, norm): runs of lines of one level, and single lines."""
    rows = lines.select("id", "conv_id", "turn", F.posexplode("lines").alias("pos", "x")).select("id", "conv_id", "turn", "pos", "x.level", "x.line")
    w = W.partitionBy("id").orderBy("pos")
    blank = F.trim("line") == ""
    new = (F.col("level") != F.lag("level", 1, -1).over(w)) | blank
    rows = rows.withColumn("run", F.sum(new.cast("int")).over(w)).filter(~blank)
    runs = rows.groupBy("id", "conv_id", "turn", "level", "run").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("ls"))
    runs = runs.select("id", "conv_id", "turn", "level", F.array_join(F.col("ls.line"), " ").alias("t"), F.lit("run").alias("kind"))
    single = rows.select("id", "conv_id", "turn", "level", F.col("line").alias("t"), F.lit("line").alias("kind"))
    d = runs.unionByName(single).select("id", "conv_id", "turn", "level", "kind", normalised(F.col("t")).alias("norm"))
    return d.filter(F.char_length("norm") > 0)


def _roots(parents: DataFrame) -> DataFrame:
    """(id, root, depth) of every row of (id, parent), by pointer doubling."""
    d = written(parents.select("id", F.coalesce("parent", "id").alias("root"), F.col("parent").isNotNull().cast("int").alias("depth")), "roots")
    while True:
        up = d.filter("depth > 0").select(F.col("id").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        new = d.join(up, "root", "left").select("id", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        new = written(new, "roots")
        if not new.join(up.select("root"), "root", "left_semi").take(1):
            return new
        d = new


def link(conversations: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, position (from 1, in reply order), parent_turn, root_turn, depth, quote_levels (the
    deepest level quoted), n_quoted and n_linked passages, and ``body``: its own text without quotes."""
    prepare(conversations.sparkSession)
    # numbered once and written: repeated rows stay apart
    m = conversations.select("conv_id", "turn", "role", "text").withColumn("id", F.monotonically_increasing_id())
    m = written(m, "messages")
    lines = _lines(m)
    own = F.filter("lines", lambda x: x["level"] == 0)
    body = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["line"]), "\n"), r"^\s+|\s+$", "")
    facts = lines.select("id", body.alias("body"), F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).alias("quote_levels"))
    facts = written(facts, "bodies")

    passages = written(_passages(lines), "passages")
    key = F.xxhash64("norm")
    whole = m.join(facts, "id").select("conv_id", "turn", normalised(F.col("body")).alias("norm")).filter(F.char_length("norm") > 0)
    originals = passages.filter("level = 0").select("conv_id", "turn", "norm").unionByName(whole).filter("turn IS NOT NULL")
    originals = originals.groupBy(F.col("conv_id").alias("oc"), key.alias("oh")).agg(F.min("turn").alias("parent_turn"))
    originals = written(originals, "originals")
    quoted = passages.filter("level > 0").withColumn("h", key)
    found = quoted.join(originals, F.col("conv_id").eqNullSafe(F.col("oc")) & (F.col("h") == F.col("oh")) & (F.col("parent_turn") < F.col("turn")), "left")
    best = F.min(F.when(F.col("parent_turn").isNotNull(), F.struct("level", (-F.char_length("norm")).alias("size"), "parent_turn"))).alias("best")
    run = F.col("kind") == "run"
    links = found.groupBy("id").agg(best, F.sum(run.cast("long")).alias("n_quoted"), F.sum((run & F.col("parent_turn").isNotNull()).cast("long")).alias("n_linked"))
    links = links.select("id", "best.parent_turn", "n_quoted", "n_linked")

    # the parent's row: of equal turns the first by number
    turns = m.filter("turn IS NOT NULL").groupBy(F.col("conv_id").alias("pc"), F.col("turn").alias("pt")).agg(F.min("id").alias("parent"))
    linked = m.drop("text", "role").join(links, "id", "left")
    linked = linked.join(turns, F.col("conv_id").eqNullSafe(F.col("pc")) & (F.col("parent_turn") == F.col("pt")), "left")
    linked = written(linked.select("id", "conv_id", "turn", "parent", "parent_turn", "n_quoted", "n_linked"), "linked")
    threads = linked.filter("parent IS NOT NULL").select("id", "parent")
    heads = threads.select(F.col("parent").alias("id")).distinct().join(threads.select("id"), "id", "left_anti").withColumn("parent", F.lit(None).cast("long"))
    roots = _roots(threads.unionByName(heads)).filter("depth > 0")
    root_turn = m.select(F.col("id").alias("root"), F.col("turn").alias("root_turn"))
    roots = roots.join(root_turn, "root").select("id", "root_turn", "depth")
    d = linked.join(roots, "id", "left").join(facts, "id").join(m.select("id", "role", "text"), "id")
    d = d.withColumn("root_turn", F.coalesce("root_turn", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0)))
    d = written(d, "threads")
    order = ["root_turn", "turn", "role", "text", "id"]
    # blocks: a thread's turns by BLOCK; rows before a block are counted on the blocks alone
    d = d.withColumn("block", F.floor(F.col("turn") / BLOCK))
    sizes = d.groupBy("conv_id", "root_turn", "block").agg(F.count("*").alias("size"))
    # many single-message threads: first by BLOCK root turns, then within
    sizes = sizes.withColumn("wide", F.floor(F.col("root_turn") / BLOCK))
    wide = sizes.groupBy("conv_id", "wide").agg(F.sum("size").alias("all"))
    outer = F.sum("all").over(W.partitionBy("conv_id").orderBy("wide").rowsBetween(W.unboundedPreceding, -1))
    wide = wide.select(F.col("conv_id").alias("wc"), F.col("wide").alias("ww"), F.coalesce(outer, F.lit(0)).alias("outer"))
    inner = F.sum("size").over(W.partitionBy("conv_id", "wide").orderBy("root_turn", "block").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.withColumn("inner", F.coalesce(inner, F.lit(0)))
    sizes = sizes.join(wide, F.col("conv_id").eqNullSafe(F.col("wc")) & F.col("wide").eqNullSafe(F.col("ww")))
    sizes = sizes.select(F.col("conv_id").alias("sc"), F.col("root_turn").alias("sr"), F.col("block").alias("sb"), (F.col("outer") + F.col("inner")).alias("before"))
    same = F.col("conv_id").eqNullSafe(F.col("sc")) & F.col("root_turn").eqNullSafe(F.col("sr")) & F.col("block").eqNullSafe(F.col("sb"))
    place = F.row_number().over(W.partitionBy("conv_id", "root_turn", "block").orderBy(*order))
    d = d.withColumn("place", place).join(sizes, same)
    zero = F.lit(0).cast("long")
    return d.select(
        "conv_id", "turn", "role", (F.col("before") + F.col("place")).alias("position"), "parent_turn", "root_turn", "depth",
        "quote_levels", F.coalesce("n_quoted", zero).alias("n_quoted"), F.coalesce("n_linked", zero).alias("n_linked"), "body",
    )
