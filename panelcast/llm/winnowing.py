"""Benchmark decontamination by winnowing (operator 9), in DataFrame functions only.

A text's words are hashed, every ``K`` = 5 consecutive words give a k-gram hash, and in each window of consecutive k-grams
the one with the least hash is kept with its place. A window covers exactly as many words as the shortest span to be found
(13: nine k-grams of five words), so any shared span of 13 words has a fingerprint on both sides, at the same place within
the span. Items of fewer words are found as wholes, with the window for their own length (at most 12 lengths, each only if
the benchmark has such an item).

Document fingerprints meet the written benchmark fingerprints in a join (Spark broadcasts the smaller side only if its
measured size allows, and sorts both otherwise). A match fixes a diagonal (document place - item place); along it the words
of both texts are compared, and runs of equal words of the full length count as hits. So a hash collision costs a
comparison, never a wrong hit. Matches are kept per distinct text: copies are compared once.

Cases: null text has no words, no hits, and is not contaminated; items without words occur nowhere; repeated rows get equal
results; an item whose id is null makes hits but is neither counted nor listed; an empty table on either side gives no hits;
other columns are not read (``decontaminate`` keeps them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SPAN = 13
K = 5
#: What lies between the words of a lower-cased text, and of a text as it is.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The low bits of a fingerprint hold its place (modulo 2**20), which also settles equal hashes.
PLACE = (1 << 20) - 1
MIN_PCT = 5


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased (an ASCII text takes the faster ``lower``); none for null."""
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return _apart(folded, BETWEEN)


def _apart(text: Column, between: str) -> Column:
    # cutting is several times quicker than extracting matches; only the ends can be empty
    return F.coalesce(F.array_remove(F.split(text, between), ""), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """The number of ``words_of`` a text, which needs no lower case; 0 for null."""
    return F.size(_apart(text, BETWEEN_ANY_CASE)).cast("long")


def fingerprints(df: DataFrame, span: int, keys: list[str]) -> DataFrame:
    """(keys, span, fp, place) of the rows' ``__h`` word hashes: the winnowed k-grams for shared spans of ``span`` words."""
    k = min(K, span)
    window = span - k + 1
    n = F.size("__h")
    d = df.filter(n >= span)

    def gram(i: Column) -> Column:
        h = F.xxhash64(F.lit(k), *[F.get(F.col("__h"), i + j) for j in range(k)])
        return h.bitwiseAND(~PLACE).bitwiseOR(i.bitwiseAND(F.lit(PLACE)).cast("long"))

    d = d.select(*keys, F.transform(F.sequence(F.lit(0), n - k), gram).alias("__g"))
    least = lambda s: F.array_min(F.slice(F.col("__g"), s + 1, window))
    d = d.select(*keys, F.transform(F.sequence(F.lit(0), F.size("__g") - window), least).alias("__m"))
    new = lambda x, s: (s == 0) | (x != F.get(F.col("__m"), s - 1))
    starts = F.filter(F.sequence(F.lit(0), F.size("__m") - 1), lambda s: new(F.get(F.col("__m"), s), s))
    at = lambda s: F.struct(F.get(F.col("__m"), s).alias("e"), s.alias("s"))
    d = d.select(*keys, F.explode(F.transform(starts, at)).alias("__f"))
    e, s = F.col("__f.e"), F.col("__f.s")
    place = s + ((e - s).bitwiseAND(PLACE)).cast("int")
    return d.select(*keys, F.lit(span).alias("span"), e.bitwiseAND(~PLACE).alias("fp"), place.alias("place"))


def _hashed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, words_of(F.col("__text")).alias("__w")).select(*keys, F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"))


def _all_fingerprints(df: DataFrame, spans: list[int], keys: list[str]) -> DataFrame:
    d = _hashed(df, keys)
    return reduce(DataFrame.unionByName, [fingerprints(d, s, keys) for s in spans])


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(th, n_hit, items): of each distinct document text (by hash) with a hit, its hit words and the occurring items' ids."""
    items = benchmark.select("item_id", F.col("text").alias("__text")).filter(F.col("text").isNotNull()).distinct()
    items = items.select("item_id", "__text", F.xxhash64("__text").alias("ik"), words_of(F.col("__text")).alias("iw"))
    items = written(items.filter(F.size("iw") > 0), "items")
    # at most 13 values
    spans = sorted(r[0] for r in items.select(F.least(F.size("iw"), F.lit(SPAN))).distinct().collect())
    empty = docs.sparkSession.createDataFrame([], "th long, n_hit long, items array<string>")
    if not spans:
        return empty
    length = F.least(F.size("iw"), F.lit(SPAN))
    item_texts = items.select("ik", "__text", length.alias("own")).distinct()
    bench = written(_all_fingerprints(item_texts, spans, ["ik", "own"]).filter("span = own").drop("own"), "item-fingerprints")
    bench = bench.withColumnRenamed("place", "item_place")

    texts = docs.select(F.col("text").alias("__text")).filter(F.col("text").isNotNull())
    texts = texts.withColumn("th", F.xxhash64("__text"))
    found = _all_fingerprints(texts, spans, ["th"]).join(bench, ["span", "fp"])
    anchors = written(found.select("th", "ik", "span", (F.col("place") - F.col("item_place")).alias("diag")).distinct(), "anchors")

    some = texts.join(anchors.select("th").distinct(), "th", "left_semi").dropDuplicates(["th"])
    some = some.select("th", words_of(F.col("__text")).alias("dw"))
    by_text = items.groupBy("ik").agg(F.first("iw").alias("iw"))
    pairs = anchors.join(by_text, "ik").join(some, "th")
    same = F.transform(F.sequence(F.lit(0), F.size("iw") - 1), lambda j: F.when((F.col("diag") + j >= 0) & (F.get("iw", j) == F.get(F.col("dw"), F.greatest(F.col("diag") + j, F.lit(0)))), F.lit("1")).otherwise(F.lit("0")))
    pairs = pairs.select("th", "ik", "span", "diag", F.array_join(same, "").alias("same"))
    runs = F.regexp_extract_all("same", F.lit("(0+|1+)"), F.lit(1))
    mask = F.transform(runs, lambda r: F.when(r.startswith("1") & (F.length(r) >= F.col("span")), r).otherwise(F.repeat(F.lit("0"), F.length(r))))
    pairs = pairs.select("th", "ik", "diag", F.array_join(mask, "").alias("mask")).filter(F.col("mask").contains("1"))
    pairs = written(pairs, "hits")
    places = pairs.select("th", (F.posexplode(F.split("mask", "")).alias("j", "x")), "diag").filter("x = '1'")
    n_hit = places.select("th", (F.col("diag") + F.col("j")).alias("p")).distinct().groupBy("th").agg(F.count("*").alias("n_hit"))
    ids = pairs.select("th", "ik").distinct().join(items.select("ik", F.col("item_id").cast("string").alias("id")), "ik")
    ids = ids.groupBy("th").agg(F.sort_array(F.collect_set("id")).alias("items"))
    return n_hit.join(ids, "th")


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    d = docs.select("doc_id", F.xxhash64("text").alias("th"), word_count(F.col("text")).alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return d.join(hits(docs, benchmark), "th", "left").select(
        "doc_id", "th", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (F.lit(100) * n_hit >= F.lit(MIN_PCT) * F.col("n_words"))).alias("contaminated"),
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    return _judged(docs, benchmark).drop("th")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = _judged(docs.select("doc_id", "text"), benchmark).filter("contaminated").select(F.col("th").alias("__llm_th")).distinct()
    kept = docs.withColumn("__llm_key", F.xxhash64("text"))
    return kept.join(bad, F.col("__llm_key") == F.col("__llm_th"), "left_anti").select(*docs.columns)
