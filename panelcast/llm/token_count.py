"""Token counts by a count-only Viterbi (operator 7).

An Aho-Corasick automaton over the unigram vocabulary lists every piece that ends at each place of a chunk, longest first;
dynamic programming carries the best score and its number of pieces, nothing else. A way to a place replaces another only
if its score is greater, so of equal ones the longest last piece stays: the tokenizer's own rule (see ``pieces``). An unknown
character counts as its UTF-8 bytes where the vocabulary has byte pieces.

Cases: null or empty text has no tokens and score 0; repeated rows get equal results; long texts are counted whole; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare
from .nbest import MODEL
from .pieces import Memo, Vocabulary, chunks, load, neighbours, parts, piece_automaton


class Counter:
    def __init__(self, v: Vocabulary):
        self.v, self.pairs = v, neighbours(v)
        self.automaton = piece_automaton(v)
        self.known = {p for p in v.pieces if len(p) == 1}
        self.memo = Memo(self.chunk)

    def chunk(self, s: str) -> tuple[float, int]:
        """Best score of a chunk and its number of pieces, from its parts."""
        own = parts(s, self.pairs)
        if len(own) == 1:
            return self.count(s)
        got = [self.memo[p] for p in own]
        return sum([g[0] for g in got]), sum([g[1] for g in got])

    def count(self, s: str) -> tuple[float, int]:
        """Best score and number of pieces of a part."""
        n = len(s)
        best, count = [float("-inf")] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        unknown = [] if self.known.issuperset(s) else [i for i, c in enumerate(s) if c not in self.known]
        for last, (length, _, score) in self.automaton.iter(s):
            while unknown and unknown[0] < last:  # nothing ends there but longer pieces, which have been seen
                self._unknown(s, unknown.pop(0), best, count)
            x = best[last + 1 - length] + score
            if x > best[last + 1]:
                best[last + 1] = x
                count[last + 1] = count[last + 1 - length] + 1
        for at in unknown:
            self._unknown(s, at, best, count)
        return best[n], count[n]

    def _unknown(self, s: str, at: int, best: list[float], count: list[int]) -> None:
        """The way to the place behind an unknown character: it starts last, so it wins only by a greater score."""
        x = best[at] + self.v.unknown_score
        if x > best[at + 1]:
            best[at + 1] = x
            count[at + 1] = count[at] + (len(s[at].encode("utf-8", "surrogatepass")) if self.v.byte_ids else 1)

    def text(self, t: str | None) -> tuple[int, float]:
        if not t:
            return 0, 0.0
        got = [self.memo[s] for s in chunks(t)]
        return sum(g[1] for g in got), sum(g[0] for g in got)


_counters: dict = {}


def count(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens and score of every document's best segmentation."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = getattr(sent, "id", id(sent))
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter(sent.value)
        c = _counters[key]
        for b in batches:
            got = [c.text(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.float64())],
                ["doc_id", "n_tokens", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, score double")
