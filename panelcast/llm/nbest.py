"""SentencePiece encoding and decoding with N-best segmentations (operator 1).

In each chunk's piece lattice a forward Viterbi pass gives the best score of every place. These scores are exact
heuristics for the A-star search that runs backwards from the chunk's end: what it takes from its heap is always the next
best segmentation, and its memory does not grow with the paths that tie. The Viterbi pass also gives the loss of a chunk's second best segmentation, so of a whole text only the
``n - 1`` chunk occurrences with the least losses are searched; their alternatives are merged best first into the text's N
best segmentations (every path that differs elsewhere is no better).

Equal scores: the first is the tokenizer's own choice (see ``pieces``), the others follow in order of the differing chunks.
Decoding joins the pieces, turns bytes back into characters and takes off the first blank.

Cases: null or empty text has one empty segmentation of score 0; U+2581 in a text reads as a blank; repeated rows get equal
results; long texts are encoded whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare
from .pieces import BLANK, MEMO, Memo, Vocabulary, chunks, load, neighbours, parts, piece_automaton, unknown_ids

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
#: Chunks that a Python worker remembers in each of two generations (some 250 bytes each).
CHUNKS = 600_000


Edge = tuple[int, int, float]  # start, id (-1: an unknown character), score


def _into(v: Vocabulary, s: str, end: int) -> list[Edge]:
    """The lattice's edges that end at a place, by start."""
    out = []
    for start in range(max(0, end - v.longest), end):
        p = v.pieces.get(s[start:end])
        if p:
            out.append((start, p[0], p[1]))
    if s[end - 1] not in v.pieces:
        out.append((end - 1, -1, v.unknown_score))
    return out


def _forward(v: Vocabulary, s: str) -> tuple[list[float], list[Edge]]:
    """Viterbi: the best score of each place and the edge it comes by."""
    best, by = [0.0], [(0, 0, 0.0)]
    for end in range(1, len(s) + 1):
        top, edge = None, None
        for e in _into(v, s, end):
            x = best[e[0]] + e[2]
            if top is None or x > top:
                top, edge = x, e
        best.append(top)
        by.append(edge)
    return best, by


def _ids(v: Vocabulary, s: str, path: list[tuple[int, int, int]]) -> tuple[int, ...]:
    out: list[int] = []
    for start, end, i in path:
        out.extend(unknown_ids(v, s[start:end]) if i < 0 else (i,))
    return tuple(out)


def best_of(v: Vocabulary, s: str, automaton=None) -> tuple[float, tuple[int, ...], float]:
    """Score and ids of a chunk's best segmentation, and the loss of the second best (infinite if there is none). With an
    automaton over the pieces, which a chunk without unknown characters needs, its matches are the lattice's edges."""
    n, none = len(s), float("-inf")
    best, second = [none] * (n + 1), [none] * (n + 1)
    start, piece = [0] * (n + 1), [0] * (n + 1)
    best[0] = 0.0
    if automaton:
        for end, (length, i, score) in automaton.iter(s):
            end += 1
            x = best[end - length] + score
            if x > best[end]:
                second[end] = best[end]
                best[end] = x
                start[end] = end - length
                piece[end] = i
            elif x > second[end]:
                second[end] = x
    else:
        for end in range(1, n + 1):
            for b, i, score in _into(v, s, end):
                x = best[b] + score
                if x > best[end]:
                    second[end], best[end], start[end], piece[end] = best[end], x, b, i
                elif x > second[end]:
                    second[end] = x
    ids, end, loss = [], n, float("inf")
    while end:
        if best[end] - second[end] < loss:
            loss = best[end] - second[end]
        b = start[end]
        if piece[end] < 0:
            ids.extend(unknown_ids(v, s[b:end])[::-1])
        else:
            ids.append(piece[end])
        end = b
    ids.reverse()
    return best[n], tuple(ids), loss


def search(v: Vocabulary, s: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """A chunk's ``n`` best segmentations: A-star backwards from the end, the tokenizer's own choice first.

    A hypothesis goes back from the end by the forward pass's best edges but for the side edges it names; what the forward
    scores lose by a side edge is exact, so the heap's first hypothesis is always the next best path. Its successors take
    one more side edge further back; only the n - 1 with the least losses can still be wanted. So the heap holds n * n
    hypotheses at most, however long the chunk and however many paths tie.
    """
    best, by = _forward(v, s)

    def sides(end: int) -> Iterator[tuple[float, int, int, int]]:
        while end:
            for start, i, score in _into(v, s, end):
                if start != by[end][0]:
                    yield best[end] - best[start] - score, end, start, i
            end = by[end][0]

    heap: list[tuple[float, tuple[tuple[int, int, int], ...]]] = [(0.0, ())]
    found = []
    while heap and len(found) < n:
        loss, taken = heapq.heappop(heap)
        side, path, end = {e: (b, i) for e, b, i in taken}, [], len(s)
        while end:
            start, i = side.get(end) or by[end][:2]
            path.append((start, end, i))
            end = start
        found.append((best[-1] - loss, _ids(v, s, path[::-1])))
        for more, end, start, i in heapq.nsmallest(n - 1, sides(taken[-1][1] if taken else len(s))):
            heapq.heappush(heap, (loss + more, (*taken, (end, start, i))))
    return found


#: Stand for the bytes 0 to 255 while pieces are joined: code points of a private plane that no vocabulary piece may hold.
_BYTES = re.compile("[\U000F0000-\U000F00FF]+")


class Decoder:
    def __init__(self, v: Vocabulary):
        self.text = list(v.text)
        if any(_BYTES.search(p) for p in v.text):
            raise ValueError("a piece holds a code point that stands for a byte")
        for b, i in enumerate(v.byte_ids):
            self.text[i] = chr(0xF0000 + b)

    def pieces(self, ids) -> str:
        """The pieces' joined text, with the first blank."""
        text = self.text
        joined = "".join([text[i] for i in ids])
        joined = _BYTES.sub(lambda m: bytes(ord(c) - 0xF0000 for c in m[0]).decode("utf-8", "replace"), joined)
        return joined.replace(BLANK, " ")

    def __call__(self, ids: list[int]) -> str:
        """The text of a list of ids."""
        return self.pieces(ids).removeprefix(" ")


def packed(ids) -> bytes:
    """The ids' 4-byte little-endian forms."""
    return array("i", ids).tobytes()


def unpacked(body: bytes) -> list[int]:
    out = array("i")
    out.frombytes(body)
    return out.tolist()


class Encoder:
    """Encodes and decodes whole texts; remembers chunks. Ids are kept packed, so a document's are its chunks' bytes in a row, and
    whether a chunk decodes to itself is known with it: a run of byte pieces never goes beyond a chunk, so a document decodes to
    itself where its chunks do."""

    def __init__(self, v: Vocabulary, n: int, remembered: int = CHUNKS):
        self.v, self.n, self.decode = v, n, Decoder(v)
        self.automaton = piece_automaton(v)
        self.known = {p for p in v.pieces if len(p) == 1}
        self.pairs = neighbours(v)
        self.best = Memo(self._best, remembered)
        self.more = Memo(self._more, min(remembered, MEMO))
        self.part = Memo(self._part, min(remembered, MEMO))

    def _part(self, part: str) -> tuple[float, tuple[int, ...], float, bool]:
        """A part's best segmentation, and whether it decodes to the part: it does where all characters are pieces, as its pieces
        are then the part's own text."""
        plain = self.known.issuperset(part)
        score, ids, loss = best_of(self.v, part, self.automaton if plain else None)
        return score, ids, loss, plain or self._sound(part, ids)

    def _best(self, chunk: str) -> tuple[float, bytes, float, bool]:
        """A chunk's best segmentation, put together from its parts': score, packed ids, least loss of another one, and whether it
        decodes to the chunk."""
        own = parts(chunk, self.pairs)
        if len(own) == 1:
            score, ids, loss, sound = self._part(chunk)
            return score, packed(ids), loss, sound
        got = [self.part[s] for s in own]
        ids = [i for g in got for i in g[1]]
        return sum([g[0] for g in got]), packed(ids), min([g[2] for g in got]), all([g[3] for g in got])

    def _sound(self, chunk: str, ids) -> bool:
        return self.decode.pieces(ids) == chunk.replace(BLANK, " ")

    def _more(self, chunk: str) -> tuple[list[tuple[float, bytes]], bool]:
        """A chunk's N best segmentations, and whether every one of them decodes to the chunk."""
        found = search(self.v, chunk, self.n)
        return [(score, packed(ids)) for score, ids in found], all(self._sound(chunk, ids) for _, ids in found)

    def segment(self, text: str | None) -> tuple[list[tuple[float, bytes]], bool]:
        """(score, packed ids) of the N best segmentations, best first, and whether each decodes to the text. The alternatives
        differ from the best one in whole chunks, so theirs is known from those chunks."""
        if not text:
            return [(0.0, b"")], True
        whole = chunks(text)
        best = self.best
        scores, bodies, losses, sounds = zip(*[best[s] for s in whole], strict=True)
        total = sum(scores)
        out, sound = [(total, b"".join(bodies))], all(sounds)
        if self.n == 1:
            return out, sound
        combos: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]  # (loss, ((place, rank), ...))
        bound = heapq.nsmallest(self.n - 1, losses)[-1]
        near = sorted([(loss, k) for k, loss in enumerate(losses) if loss <= bound])  # the first of equal ones first
        for _, place in near[: self.n - 1]:
            options, decodes = self.more[whole[place]]
            sound &= decodes
            top = options[0][0]
            grown = [(loss + top - sc, (*c, (place, r)) if r else c) for loss, c in combos for r, (sc, _) in enumerate(options)]
            combos = heapq.nsmallest(self.n, grown, key=lambda x: (x[0], sorted(x[1])))
        for loss, c in combos[1:]:
            other = list(bodies)
            for place, rank in c:
                other[place] = self.more[whole[place]][0][rank][1]
            out.append((total - loss, b"".join(other)))
        return out, sound

    def encode(self, text: str | None) -> list[tuple[float, list[int]]]:
        """(score, ids) of the N best segmentations, best first."""
        return [(score, unpacked(body)) for score, body in self.segment(text)[0]]


_encoders: dict[tuple, Encoder] = {}


def _encoder(sent, n: int, remembered: int) -> Encoder:
    """One encoder for each Python worker and broadcast."""
    key = (sent.id if hasattr(sent, "id") else id(sent), n, remembered)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(sent.value, n, remembered)
    return _encoders[key]


def _over_texts(docs: DataFrame, model: str, n: int, rows, schema: str, remembered: int = CHUNKS) -> DataFrame:
    """Run ``rows(encoder, texts)`` -> columns over doc_id and text."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(load(model))
    types = spark.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        e, arrow = _encoder(sent, n, remembered), to_arrow_schema(types)
        for b in batches:
            columns = rows(e, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True))], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, types)


def encode(docs: DataFrame, model: str = MODEL, n: int = N_BEST) -> DataFrame:
    """doc_id and its ``segmentations``: array of (score, ids), best first."""

    def rows(e: Encoder, texts: list):
        return ([[{"score": s, "ids": ids} for s, ids in e.encode(t)] for t in texts],)

    return _over_texts(docs, model, n, rows, "doc_id long, segmentations array<struct<score: double, ids: array<int>>>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the text of each row's first segmentation, from the frame that ``encode`` gives."""
    prepare(encoded.sparkSession)
    sent = encoded.sparkSession.sparkContext.broadcast(load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Decoder(sent.value)
        for b in batches:
            texts = [of(ids or []) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr("doc_id", "segmentations[0].ids AS ids").mapInArrow(run, "doc_id long, text string")


def report(docs: DataFrame, model: str = MODEL, n: int = N_BEST, remembered: int = CHUNKS) -> DataFrame:
    """Per document: tokens, score and ids of the best segmentation, the scores of the N best, a digest of the ids of each (their
    4-byte little-endian forms, SHA-256 in hex), and whether decoding every one gives the text back. ``remembered`` chunks
    stay in each of a worker's two generations: less memory for more time, the same rows."""

    def rows(e: Encoder, texts: list):
        tokens, best, bodies, scores, digests, back = [], [], [], [], [], []
        for t in texts:
            got, sound = e.segment(t)
            tokens.append(len(got[0][1]) // 4)
            best.append(got[0][0])
            bodies.append(got[0][1])
            scores.append([s for s, _ in got])
            digests.append([hashlib.sha256(body).hexdigest() for _, body in got])
            back.append(sound)
        ends = np.cumsum([0, *tokens], dtype=np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(bodies), "<i4")))
        return tokens, best, scores, digests, back, ids

    schema = "doc_id long, n_tokens long, score double, nbest_scores array<double>, nbest_sha256 array<string>, round_trip boolean, ids array<int>"
    return _over_texts(docs, model, n, rows, schema, remembered)
