"""Quality rules with n-gram perplexity (operator 2).

A character 5-gram model with modified Kneser-Ney smoothing is counted over every whole text, one model per language,
and stored as two parallel arrays sorted by hash (slot, log probability). A document is scored by binary search of its
distinct n-grams; its perplexity must lie between its language's lower and upper bound.

* Counting: each task reduces its texts to distinct 60-bit n-gram keys before anything is shuffled; Spark sums the
  counts by (lang, key). No key is dropped.
* Estimation: five joins over the n-gram table (its size follows the number of distinct n-grams, not of characters).
* Storage: (lang, key) is hashed to ``bits`` bits, so the broadcast holds at most ``2**bits`` entries of 8 bytes (128 MB
  at 24 bits) at any corpus size. N-grams that share a slot share their count-weighted mean log probability.
* Bands: from the same table, each language's mean and standard deviation of the surprisal per character; a document of
  n characters passes if its mean surprisal (the log of its perplexity) lies between ``BAND_LOW`` standard deviations below
  and ``BAND_HIGH`` above the mean, both widened by ``BAND_SHORT / sqrt(n)``.

The query and the pipeline use ``judge`` and ``filter_judged``: the model is counted over the distinct texts of each
language, and the bounds come from the medians and quartiles of the surprisal of distinct texts that pass the base rules,
by language and size class, so that copies move neither. ``score`` and ``filter_documents`` count every row and use the
bands above.

Symbols are code points of the lower-cased text, digits read as 0 and white space as a blank; those of U+1000 and above
are hashed into 11 bits (a documented collision).

Cases: null or empty text has no words, fails the base rules and has null perplexity; a null language is a language
of its own (''); repeated rows get equal results; very long texts are scored whole; an empty table gives an empty result;
other columns are passed over by ``score`` and kept unchanged by ``filter_documents``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

ORDER = 5
SYMBOL_BITS = 12
BOS, EOS, LOW = 2, 3, 4
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
REPEAT_WINDOW = 5
#: A band reaches this many standard deviations of a character's surprisal below and above the language's mean, and
#: further for a short text of n characters by BAND_SHORT / sqrt(n). The lower side leaves room for texts copied often.
BAND_LOW = 0.30
BAND_HIGH = 0.35
BAND_SHORT = 3.0
SLOT_BITS = 24
#: ``judge``: a document may lie so many times the distance from its group's median to the quartile below and above.
#: The lower side leaves room for near copies, which know each other's n-grams.
REACH_LOW, REACH_HIGH = 10.0, 6.0
#: A group of fewer distinct texts sets no bounds: its language's do, or none.
LEAST_TEXTS = 40
#: Distinct n-grams a counting task holds before it hands them on.
FLUSH = 2_000_000

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, surprisal double, n long"
VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, perplexity double"


def _symbol_table() -> np.ndarray:
    lut = np.arange(1 << SYMBOL_BITS, dtype=np.int64)
    lut[:LOW] = LOW
    lut[9:14] = 32
    lut[48:58] = 48
    return lut


_LUT = _symbol_table()


def ngram_keys(text: str) -> np.ndarray:
    """The 5-gram key ending at each character, and at the end, of a text."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    cp = np.where(cp < (1 << SYMBOL_BITS), cp, 2048 + ((cp * 40503) & 2047))
    s = np.empty(len(cp) + ORDER, dtype=np.int64)
    s[: ORDER - 1] = BOS
    s[ORDER - 1 : -1] = _LUT[cp]
    s[-1] = EOS
    n = len(cp) + 1
    key = s[:n].copy()
    for i in range(1, ORDER):
        key <<= SYMBOL_BITS
        key |= s[i : i + n]
    return key


def slots_of(lang: str, keys: np.ndarray, bits: int = SLOT_BITS) -> np.ndarray:
    """Hash of (lang, n-gram key) into ``bits`` bits."""
    h = keys.astype(np.uint64) ^ np.uint64(zlib.crc32(lang.encode("utf-8", "surrogatepass")) << 16)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - bits)).astype(np.int32)


class _Counts:
    """Distinct keys with counts of one language, merged whenever the pending ones outgrow them."""

    def __init__(self):
        self.keys, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
        self.new: list[np.ndarray] = []
        self.pending = 0

    def add(self, keys: np.ndarray) -> None:
        self.new.append(keys)
        self.pending += len(keys)
        if self.pending > 1_000_000 + len(self.keys):
            self.merge()

    def merge(self) -> None:
        if not self.new:
            return
        k, n = np.unique(np.concatenate(self.new), return_counts=True)
        self.new, self.pending = [], 0
        if not len(self.keys):
            self.keys, self.n = k, n
            return
        both, counts = np.concatenate([self.keys, k]), np.concatenate([self.n, n])
        order = np.argsort(both, kind="stable")
        both, counts = both[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        self.keys, self.n = both[first], np.add.reduceat(counts, first)


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, _Counts] = {}

    def out(lang: str, c: _Counts) -> Iterator[pd.DataFrame]:
        c.merge()
        for i in range(0, len(c.keys), 100_000):
            yield pd.DataFrame({"lang": lang, "key": c.keys[i : i + 100_000], "n": c.n[i : i + 100_000]})

    for b in batches:
        for text, lang in zip(b["text"], b["lang"], strict=True):
            c = held.get(lang)
            if c is None:
                c = held[lang] = _Counts()
            c.add(ngram_keys(text))
        if sum(len(c.keys) + c.pending for c in held.values()) > 3 * FLUSH:
            for lang, c in held.items():
                yield from out(lang, c)
            held = {}
    for lang, c in held.items():
        yield from out(lang, c)


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, key, a): 5-gram counts over every whole text."""
    texts = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), "text").filter(F.col("text").isNotNull())
    parts = texts.mapInPandas(_count_batches, "lang string, key long, n long")
    return parts.groupBy("lang", "key").agg(F.sum("n").alias("a"))


def _discounts(a: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts d1, d2, d3 by language, from the counts of counts."""
    n = a.groupBy("lang").agg(*[F.sum((F.col("a") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)])
    full = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def d(i: int) -> F.Column:
        v = i - (i + 1) * y * F.try_divide(f"n{i + 1}", f"n{i}")
        return F.when(full & (v > 0) & (v <= i), v).otherwise(F.lit(i / 2.0)).alias(f"d{i}")

    return n.select("lang", d(1), d(2), d(3))


def estimate(counts: DataFrame) -> DataFrame:
    """(lang, key, a, logp): natural log of the interpolated modified Kneser-Ney probability of each 5-gram's last symbol."""
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        mask = (1 << (SYMBOL_BITS * k)) - 1
        tables[k] = written(tables[k + 1].groupBy("lang", F.col("key").bitwiseAND(mask).alias("key")).agg(F.count("*").alias("a")), f"order{k}")
    lower = None
    for k in range(1, ORDER + 1):
        a = tables[k].withColumn("ctx", F.shiftright("key", SYMBOL_BITS))
        one = lambda c: F.sum(c.cast("double"))
        ctx = a.groupBy("lang", "ctx").agg(
            F.sum("a").cast("double").alias("tot"),
            one(F.col("a") == 1).alias("m1"), one(F.col("a") == 2).alias("m2"), one(F.col("a") >= 3).alias("m3"),
            F.count("*").alias("kinds"),
        )
        x = a.join(ctx, ["lang", "ctx"]).join(_discounts(tables[k]), "lang")
        cut = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = F.greatest(F.col("a") - cut, F.lit(0.0)) / F.col("tot")
        gamma = (F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / F.col("tot")
        if k == 1:
            lower = x.select("lang", F.col("key").alias("low"), (own + gamma / (F.col("kinds") + 1)).alias("p_low"))
        else:
            mask = (1 << (SYMBOL_BITS * (k - 1))) - 1
            x = x.select("lang", "key", "a", own.alias("own"), gamma.alias("gamma"), F.col("key").bitwiseAND(mask).alias("low"))
            p = x.join(lower, ["lang", "low"]).withColumn("p", F.col("own") + F.col("gamma") * F.col("p_low"))
            lower = written(p.select("lang", F.col("key").alias("low"), F.col("p").alias("p_low")), f"p{k}") if k < ORDER else None
    return p.select("lang", "key", "a", F.log("p").alias("logp"))


class Model:
    """Sorted hash arrays and the perplexity bands, as broadcast to the tasks."""

    def __init__(self, slots: np.ndarray, logp: np.ndarray, bands: dict[str, tuple[float, float]], bits: int):
        order = np.argsort(slots)
        self.slots, self.logp, self.bands, self.bits = slots[order], logp[order], bands, bits

    def surprisal(self, lang: str, text: str) -> tuple[float, int]:
        """Mean surprisal of a character in nats, and the number of characters with the end."""
        keys = ngram_keys(text)
        slots, n = np.unique(slots_of(lang, keys, self.bits), return_counts=True)
        at = np.searchsorted(self.slots, slots)
        at[at == len(self.slots)] = 0
        found = self.slots[at] == slots if len(self.slots) else np.zeros(len(slots), bool)
        floor = float(self.logp.min()) if len(self.logp) else -1.0
        lp = np.where(found, self.logp[at], floor) if len(self.slots) else np.full(len(slots), floor)
        return float(-(lp * n).sum() / len(keys)), len(keys)

    def verdict(self, lang: str, text: str) -> tuple[float, bool]:
        h, n = self.surprisal(lang, text)
        mean, std = self.bands.get(lang, (h, 0.0))
        short = BAND_SHORT / np.sqrt(n)
        inside = mean - std * (BAND_LOW + short) <= h <= mean + std * (BAND_HIGH + short)
        return float(np.exp(min(h, 700.0))), bool(inside)


def fit(docs: DataFrame, bits: int = SLOT_BITS) -> Model:
    """Count and estimate over all documents; the driver gets at most ``2**bits`` (slot, log probability) entries and a
    row per language."""
    grams = written(estimate(written(count_ngrams(docs), "grams")), "kneser-ney")
    slot = F.pandas_udf(lambda lang, key: _slot_series(lang, key, bits), "int")
    by_slot = grams.groupBy(slot("lang", "key").alias("slot")).agg(
        (F.sum(F.col("a") * F.col("logp")) / F.sum("a")).cast("float").alias("logp")
    )
    got = by_slot.toArrow()
    band = (
        grams.groupBy("lang")
        .agg(*[F.sum(e).alias(n) for n, e in {"w": F.col("a"), "s": F.col("a") * F.col("logp"), "q": F.col("a") * F.col("logp") ** 2}.items()])
        .collect()
    )
    bands = {r["lang"]: (-r["s"] / r["w"], float(np.sqrt(max(r["q"] / r["w"] - (r["s"] / r["w"]) ** 2, 0.0)))) for r in band}
    return Model(got.column("slot").to_numpy(), got.column("logp").to_numpy(), bands, bits)


def _slot_series(lang: pd.Series, key: pd.Series, bits: int) -> pd.Series:
    out = np.empty(len(key), np.int32)
    for name, at in lang.groupby(lang).indices.items():
        out[at] = slots_of(name, key.to_numpy(np.int64)[at], bits)
    return pd.Series(out)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = WORD.findall(text)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    repeat = 0
    k = REPEAT_WINDOW
    if len(words) > k:
        windows = list(zip(*(words[i:] for i in range(k)), strict=False))
        if len(set(windows)) < len(windows):
            times = Counter(windows)
            covered = -1
            for i, w in enumerate(windows):
                if times[w] > 1:
                    repeat += i + k - 1 - max(covered, i - 1)
                    covered = i + k - 1
    return len(words), sum(map(len, words)), len(SYMBOLS.findall(text)), dup, repeat


def verdict_column(model: Model, spark, text: F.Column, lang: F.Column) -> F.Column:
    """Struct column with the base counts, the verdict and the perplexity of each text."""
    sent = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for texts, langs in batches:
            rows = []
            for t, g in zip(texts, langs, strict=True):
                b = base_counts(t)
                failed = b[0] < MIN_WORDS or 100 * b[4] > MAX_REPEAT_PCT * b[0]
                ppl, inside = m.verdict(g or "", t) if t else (None, False)
                rows.append((*b, failed, not failed and inside, ppl))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in VERDICT.split(", ")])

    judge.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(judge, VERDICT)(text, lang)


def score(docs: DataFrame, bits: int = SLOT_BITS) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and perplexity of every document."""
    prepare(docs.sparkSession)
    d = docs.select("doc_id", "text", "lang")
    v = verdict_column(fit(d, bits), docs.sparkSession, d["text"], d["lang"])
    return d.select("doc_id", v.alias("v")).select("doc_id", "v.*")


def filter_documents(docs: DataFrame, bits: int = SLOT_BITS) -> DataFrame:
    """The documents that pass, with all their columns."""
    prepare(docs.sparkSession)
    v = verdict_column(fit(docs.select("text", "lang"), bits), docs.sparkSession, docs["text"], docs["lang"])
    return docs.withColumn("__llm_v", v).filter("__llm_v.kept").select(*[docs[c] for c in docs.columns])


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(lang, text): each text of a language once, however often it is copied."""
    return docs.select(F.coalesce("lang", F.lit("")).alias("lang"), "text").filter(F.col("text").isNotNull()).distinct()


def _measured(model: Model, spark, text: F.Column, lang: F.Column) -> F.Column:
    """Struct column with the base counts, the mean surprisal and the number of characters with the end."""
    sent = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for texts, langs in batches:
            rows = []
            for t, g in zip(texts, langs, strict=True):
                b = base_counts(t)
                failed = b[0] < MIN_WORDS or 100 * b[4] > MAX_REPEAT_PCT * b[0]
                rows.append((*b, failed, *(m.surprisal(g, t) if t else (None, 0))))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in MEASURES.split(", ")])

    measure.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(measure, MEASURES)(text, lang)


def _quartiles(rows: DataFrame) -> DataFrame:
    """(lang, size, lo, hi): bounds of the surprisal by language and size class (size null: the whole language), from the
    distinct texts that pass the base rules. Surprisal is counted in steps of a thousandth, so the quartiles are exact."""
    texts = rows.filter("NOT base_failed").groupBy("lang", "th", "n").agg(F.min("surprisal").alias("h"))
    steps = texts.groupBy("lang", _size(), F.round(F.col("h") * 1000).cast("long").alias("step")).agg(F.count("*").alias("times"))
    q = F.percentile("step", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("times")).alias("q")
    found = steps.rollup("lang", "size").agg(q, F.sum("times").alias("texts")).filter("lang IS NOT NULL").filter(F.col("texts") >= LEAST_TEXTS)
    lo, mid, hi = (F.col("q")[i] / 1000 for i in range(3))
    return found.select("lang", "size", (mid - REACH_LOW * (mid - lo)).alias("lo"), (mid + REACH_HIGH * (hi - mid)).alias("hi"))


def _size() -> F.Column:
    return F.floor(F.log2(F.col("n").cast("double"))).alias("size")


def _judged(rows: DataFrame) -> DataFrame:
    """Rows of _measured's fields with ``kept`` and ``perplexity``."""
    bounds = written(_quartiles(rows), "bounds")
    own = bounds.filter("size IS NOT NULL").select(F.col("lang").alias("__llm_l"), F.col("size").alias("__llm_s"), F.col("lo").alias("__llm_lo"), F.col("hi").alias("__llm_hi"))
    whole = bounds.filter("size IS NULL").select(F.col("lang").alias("__llm_w"), F.col("lo").alias("__llm_wlo"), F.col("hi").alias("__llm_whi"))
    d = rows.join(F.broadcast(own), (F.col("lang") == F.col("__llm_l")) & (_size() == F.col("__llm_s")), "left")
    d = d.join(F.broadcast(whole), F.col("lang") == F.col("__llm_w"), "left")
    inside = F.col("surprisal").between(F.coalesce("__llm_lo", "__llm_wlo"), F.coalesce("__llm_hi", "__llm_whi"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return d.withColumn("kept", kept).withColumn("perplexity", F.exp(F.least("surprisal", F.lit(700.0))))


def judge(docs: DataFrame, bits: int = SLOT_BITS) -> DataFrame:
    """The columns of ``score``; the model is counted over distinct texts, and a document passes if its surprisal lies
    within the bounds that the distinct texts of its language and size class set."""
    prepare(docs.sparkSession)
    d = docs.select("doc_id", "text", "lang")
    lang = F.coalesce("lang", F.lit(""))
    v = _measured(fit(distinct_texts(d), bits), docs.sparkSession, F.col("text"), lang)
    rows = written(d.select("doc_id", lang.alias("lang"), F.xxhash64("text").alias("th"), v.alias("v")).select("doc_id", "lang", "th", "v.*"), "measured")
    return _judged(rows).select("doc_id", *[c.split()[0] for c in VERDICT.split(", ")])


def filter_judged(docs: DataFrame, bits: int = SLOT_BITS) -> DataFrame:
    """The documents that pass ``judge``, with all their columns."""
    prepare(docs.sparkSession)
    lang = F.coalesce("lang", F.lit(""))
    v = _measured(fit(distinct_texts(docs), bits), docs.sparkSession, F.col("text"), lang)
    own = F.struct(*docs.columns).alias("__llm_row")
    rows = written(docs.select(own, lang.alias("lang"), F.xxhash64("text").alias("th"), v.alias("v")).select("__llm_row", "lang", "th", "v.*"), "measured")
    return _judged(rows).filter("kept").select("__llm_row.*")
