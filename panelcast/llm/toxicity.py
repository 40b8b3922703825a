"""Toxicity by a weighted lexicon (operator 4).

Texts are folded (lower case, homoglyphs to Latin letters, digits and signs that stand for letters) and scanned once by an
Aho-Corasick automaton of word stems: a match counts if it begins a word. Exception phrases are entries of the same
automaton; a stem inside one doesn't count. The weights' sum, its share per word and the largest weight go through a
logistic function fitted to the labels.

The lexicon is learned: of a bounded sample of labelled training documents (``MAX_TRAIN``, chosen by hash), Spark counts in
how many toxic and other documents each stem (the first 4 to 10 letters of a word, or the whole word) occurs; stems with
log odds of ``MIN_WEIGHT`` or more and support become entries, at most ``MAX_TERMS``. A longer stem of an entry that is
common in other documents becomes an exception by itself. Only labels of training rows (crc32 of doc_id mod 4 is not 2) are
read; lang, source and doc_id are no inputs of a score.

Cases: null or empty text has no match and gets the score of no match; repeated rows get equal scores; long texts are
scanned whole; without labelled rows of both classes every score is 0; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_train, prepare, written

MAX_TRAIN = 10_000
MAX_TERMS = 2_000
MIN_WEIGHT = 1.5
MIN_SUPPORT = 5
STEM = (4, 10)
THRESHOLD = 0.3

# Look-alikes of Latin letters, and digits and signs read as letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d",
    "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ӏ": "l",
    "α": "a", "ο": "o", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m", "ⅴ": "v", "ⅹ": "x",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
#: Phrases in which a stem is harmless.
EXCEPTIONS = ("trash can", "trash bin", "pond scum", "class clown", "clown fish", "clownfish", "idiot proof", "worthless stock")

_FOLD = str.maketrans(
    HOMOGLYPHS | {chr(0xFF41 + i): chr(97 + i) for i in range(26)} | {"​": None, "‍": None, "­": None}
)
_DIGITS = str.maketrans(DIGITS)
# A word with a digit or sign; tried once per word.
_MIXED = re.compile(r"(?<![\w@$])[^\W\d_]*+[0-9@$][\w@$]*+")
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case, look-alikes to Latin, and digits or signs to letters in words that mix them with letters."""
    t = text.lower().translate(_FOLD)
    return _MIXED.sub(_letters, t)


def _letters(m: re.Match) -> str:
    word = m[0].rstrip("@$")
    if not _LETTER.search(word):
        return m[0]  # a number
    return word.translate(_DIGITS) + " " * (len(m[0]) - len(word))


def stems(text: str) -> set[str]:
    lo, hi = STEM
    out: set[str] = set()
    for w in set(_WORD.findall(fold(text))):
        if len(w) >= lo:
            out.update(w[:n] for n in range(lo, min(len(w), hi) + 1))
            if len(w) <= hi + 6:
                out.add(w + " ")  # the whole word
    return out


def training_sample(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, y): at most MAX_TRAIN labelled training rows, those with the least hash of their id."""
    y = labels.filter(in_train(F.col("doc_id")) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    y = y.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)
    return written(docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(y), "doc_id"), "training")


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        toxic, other = Counter(), Counter()
        for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
            (toxic if y else other).update(stems(text))
        both = list(toxic.keys() | other.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(both, pa.string()), pa.array([toxic[s] for s in both], pa.int64()), pa.array([other[s] for s in both], pa.int64())], ["stem", "pos", "neg"]
        )


def learn_lexicon(sample: DataFrame) -> tuple[dict[str, float], set[str]]:
    """(stem -> weight, learned exceptions); both bounded by MAX_TERMS."""
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos_n, neg_n = sizes.get(1, 0), sizes.get(0, 0)
    if not pos_n or not neg_n:
        return {}, set()
    counts = sample.select("text", "y").mapInArrow(_count_stems, "stem string, pos long, neg long")
    counts = counts.groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    weight = F.log((F.col("pos") + 0.5) / (pos_n + 1)) - F.log((F.col("neg") + 0.5) / (neg_n + 1))
    scored = written(counts.withColumn("weight", weight).filter(F.col("pos") + F.col("neg") >= MIN_SUPPORT), "stems")
    chosen = scored.filter((F.col("weight") >= MIN_WEIGHT) & (F.col("pos") >= MIN_SUPPORT))
    rows = chosen.orderBy(F.desc(F.col("weight") * F.sqrt("pos")), F.length("stem"), "stem").limit(MAX_TERMS).collect()
    lexicon: dict[str, float] = {}
    for r in sorted(rows, key=lambda r: (len(r["stem"]), r["stem"])):
        # a longer stem adds nothing where a shorter one already weighs about as much
        if not any(lexicon.get(r["stem"][:n], -9.0) >= r["weight"] - 0.5 for n in range(STEM[0], len(r["stem"]))):
            lexicon[r["stem"]] = float(r["weight"])
    if not lexicon:
        return {}, set()
    heads = sample.sparkSession.createDataFrame([(k.strip(),) for k in lexicon], "head string")
    longer = scored.filter("weight < 0").filter(F.length("stem") > STEM[0])
    fronts = F.transform(F.sequence(F.lit(STEM[0]), F.length("stem") - 1), lambda n: F.substring(F.col("stem"), F.lit(1), n))
    harmless = longer.select("stem", F.explode(fronts).alias("head")).join(F.broadcast(heads), "head")  # MAX_TERMS rows at most
    found = harmless.select("stem").distinct().orderBy("stem").limit(MAX_TERMS).collect()
    return lexicon, {r["stem"] for r in found}


class Lexicon:
    def __init__(self, weights: dict[str, float], exceptions: set[str]):
        self.automaton = ahocorasick.Automaton()
        for s, w in weights.items():
            self.automaton.add_word(s.strip(), (len(s.strip()), w, s.endswith(" ")))
        for s in exceptions:
            self.automaton.add_word(s.strip(), (len(s.strip()), None, s.endswith(" ")))
        if len(self.automaton):
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) in the folded text of the stems that begin a word and stand in no exception phrase."""
        t = fold(text)
        found, safe = [], []
        if not len(self.automaton):
            return found
        for last, (n, weight, whole) in self.automaton.iter(t):
            start = last + 1 - n
            if start and t[start - 1].isalpha() or whole and last + 1 < len(t) and t[last + 1].isalpha():
                continue
            (safe if weight is None else found).append((start, last + 1, weight))
        return [m for m in found if not any(a <= m[0] and m[1] <= b for a, b, _ in safe)] if safe else found

    def features(self, text: str | None) -> list[float]:
        """The weights' sum (by word start, the largest), its log, its share per word, and the largest weight."""
        if not text:
            return [0.0, 0.0, 0.0]
        by_start: dict[int, float] = {}
        for start, _, w in self.matches(text):
            by_start[start] = max(w, by_start.get(start, 0.0))
        total = sum(by_start.values())
        words = text.count(" ") + text.count("\n") + 1
        return [float(np.log1p(total)), min(20 * total / words, 5.0), max(by_start.values(), default=0.0) / 5]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Coefficients, the intercept last (Newton steps)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _featured(sample: DataFrame, lexicon) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [lexicon.value.features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.list_(pa.float64())), b.column("y")], ["f", "y"])

    rows = sample.select("text", "y").mapInArrow(run, "f array<double>, y int").collect()  # at most MAX_TRAIN small rows
    return np.array([r["f"] for r in rows]), np.array([r["y"] for r in rows], float)


def score(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> DataFrame:
    """doc_id, held_out, score, predicted, and n_matches of every document."""
    spark = docs.sparkSession
    prepare(spark)
    sample = training_sample(docs, labels, "toxic")
    weights, learned = learn_lexicon(sample)
    sent = spark.sparkContext.broadcast(Lexicon(weights, set(exceptions) | learned))
    w = None
    if weights:
        w = fit_logistic(*_featured(sample, sent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value
        for b in batches:
            texts = b.column("text").to_pylist()
            f = np.array([lexicon.features(t) for t in texts]).reshape(-1, 3)
            s = np.zeros(len(f)) if w is None else 1 / (1 + np.exp(-np.clip(f @ w[:-1] + w[-1], -30, 30)))
            n = [len(lexicon.matches(t)) if t and x[0] else 0 for t, x in zip(texts, f, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64()), pa.array(n, pa.int64())], ["doc_id", "score", "n_matches"])

    d = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_matches long")
    return d.select("doc_id", F.coalesce(~in_train(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_matches")
