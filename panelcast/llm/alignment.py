"""Alignment of two tokenizers over the same texts (operator 12).

Both tokenizers cut the bytes of space+text. Where a token of each ends, a group ends; a link is a pair of occurrences whose byte
ranges overlap. The overlap of two ranges holds no end of either, so the links are the pieces between the union of all ends, and
a batch of documents is aligned in one go: a document's end is an end of both.

Method: (1) documents are encoded once and their ids written; (2) a task counts its pairs of ids, and these sparse partials
are dealt to ``shards`` by B id; (3) per shard a minimal perfect hash (levels of bit sets: a key that is alone at its place of a
level is set there, the others go on; its rank among all set bits is its index) covers the distinct pairs; partials become dense
count vectors indexed by it, summed by a tree (groups of tasks first, then the shard); the keys lie at their index and are
compared at each look-up; (4) the documents are aligned again and look their pairs up, block by block of shards, so that a task
holds at most ``BLOCK_PAIRS`` pairs whatever the number of distinct pairs; a document's sums over the blocks are added.

Defined cases: null, empty and such texts as either tokenizer does not give back byte for byte have no tokens and zeros; rows
with equal ids are rows of their own; an empty table gives an empty result; further columns are not looked at. Strings of
special tokens are plain text. Ids must be below 2**31.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
#: Distinct pairs of a shard on average, and of the block of shards that a task looks up at once (16 bytes each).
SHARD_PAIRS, BLOCK_PAIRS = 1 << 15, 1 << 22
#: B ids are dealt to so many parts; a shard is a range of them.
PARTS = 4096
#: Vectors of so many tasks are summed for themselves first, and so many entries are a row of a vector.
FAN_IN, CHUNK = 8, 1 << 16
GAMMA = 2  # bits for each key of a level
#: Characters that a tokenizer is given at once.
PIECE, LOT = 1 << 20, 1 << 21
#: Words that a Python worker remembers (some 150 MB).
WORDS = 1 << 20

# -- the two tokenizers -----------------------------------------------------------------------------------------------
def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


#: How the byte-level file's own splitter cuts a text before merging (fixed value: its pattern).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of other characters than these go to the file's own tokenizer: of these alone every library has the same classes.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\u00a1-\u024f]")


@lru_cache(maxsize=4)
def tokenizer_a(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """(encode a list of texts, bytes by id) of a byte-level BPE file. Where the file's merges come in the order of their ids, the
    ids are ranks, and a quicker library gives the same tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    alphabet, spec = byte_alphabet(), json.loads(t.to_str())
    entries = [t.id_to_token(i) or "" for i in range(t.get_vocab_size())]
    table = [bytes(alphabet[c] for c in e) if all(c in alphabet for c in e) else e.encode() for e in entries]
    special = {x["id"] for x in spec["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    plain = spec["pre_tokenizer"] | {"add_prefix_space": False, "trim_offsets": True, "use_regex": True} == spec["pre_tokenizer"] | {"trim_offsets": True}
    quick = None
    if plain and spec["normalizer"] is None and all("".join(m) == entries[256 + k] for k, m in enumerate(merges)):
        ranks = {b: i for i, b in enumerate(table) if i not in special}
        quick = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        slow = [k for k, x in enumerate(texts) if quick is None or _OTHER.search(x)]
        skip = set(slow)
        out = [[] if k in skip else quick.encode_ordinary(x) for k, x in enumerate(texts)]
        for k, e in zip(slow, t.encode_batch_fast([texts[k] for k in slow], add_special_tokens=False) if slow else (), strict=True):
            out[k] = e.ids
        return out

    return encode, table


@lru_cache(maxsize=4)
def tokenizer_b(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """(encode a list of texts, bytes by id) of a piece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    table = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return lambda texts: sp.encode(texts, num_threads=1), table


_CUT = re.compile(r"(?<=\S) ")


def cut(text: str, limit: int = PIECE) -> list[str]:
    """Parts of a long text, cut before blanks that follow another character: there every token of both tokenizers ends (A splits
    at blanks first, and no piece of B has a blank after another character)."""
    parts, at = [], 0
    while len(text) - at > limit and (m := _CUT.search(text, at + limit)):
        parts.append(text[at : m.start()])
        at = m.start()
    return [*parts, text[at:]]


def in_lots(encode, texts: list[str], limit: int = LOT) -> Iterator[list[int]]:
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= limit):
            size += len(texts[end])
            end += 1
        yield from encode(texts[start:end])
        start = end


def ids_type(*tables: list[bytes]) -> str:
    return "<u2" if max(map(len, tables)) <= 1 << 16 else "<i4"


class Coder:
    """Both tokenizers of a Python worker. B's tokens never hold a blank after another character, so where a text's blanks stand
    alone its words are encoded for themselves and remembered (``WORDS`` of them at most)."""

    def __init__(self, a_path: str, b_path: str, limit: int = PIECE):
        (self.encode_a, self.bytes_a), (self.encode_b, self.bytes_b) = tokenizer_a(a_path), tokenizer_b(b_path)
        self.kind, self.limit = ids_type(self.bytes_a, self.bytes_b), limit
        self.by_words = all(re.fullmatch(b" *[^ ]*", p) for p in self.bytes_b)
        self.words: dict[str, bytes | None] = {}

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def back_b(self, ids) -> bytes:
        return b"".join(map(self.bytes_b.__getitem__, ids))

    def learn(self, words: set[str]) -> None:
        """Remember the packed ids of ``words`` (none where they don't give the word back)."""
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > WORDS:
            self.words, new = {}, list(words)
        for k in range(0, len(new), 1 << 14):
            some = new[k : k + (1 << 14)]
            ids = self.encode_b(some)
            ends = np.cumsum([0, *map(len, ids)]).tolist()
            body, width = self.packed([i for x in ids for i in x]), np.dtype(self.kind).itemsize
            back = [self.back_b(x) for x in ids]
            for w, x, i, j in zip(some, back, ends, ends[1:], strict=False):
                self.words[w] = body[width * i : width * j] if x == (" " + w).encode() else None

    def side_b(self, text: str, parts: list[str]) -> bytes | None:
        """B's ids of a text; none where they don't give it back. B puts the first blank itself."""
        ids = [i for k, p in enumerate(parts) for i in self.encode_b([p[1:] if k else p])[0]]
        return self.packed(ids) if self.back_b(ids) == (" " + text).encode() else None

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """The packed ids of each text by both tokenizers; empty where either doesn't give the text back."""
        parts = [cut(t, self.limit) if t else [] for t in texts]
        flat = in_lots(self.encode_a, [p if k else " " + p for x in parts for k, p in enumerate(x)])
        words = [t.split(" ") if self.by_words and t and "  " not in t and t[0] != " " and t[-1] != " " else None for t in texts]
        self.learn(set().union(*[w for w in words if w]))
        known = self.words
        for text, x, own in zip(texts, parts, words, strict=True):
            a = next(flat) if len(x) == 1 else [i for _ in x for i in next(flat)]
            if own:
                found = [known[w] for w in own]
                b = None if None in found else b"".join(found)
            else:
                b = self.side_b(text, x) if text else None
            same = b is not None and b"".join(map(self.bytes_a.__getitem__, a)) == (" " + text).encode()
            yield (self.packed(a), b) if same else (b"", b"")


@lru_cache(maxsize=2)
def coder(a_path: str, b_path: str) -> Coder:
    return Coder(a_path, b_path)


def _encode(a_path: str, b_path: str):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(a_path, b_path)
        for batch in batches:
            found = list(own.encode([t or "" for t in batch.column(2).to_pylist()]))
            sides = [pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *sides], schema=schema)

    return run


# -- alignment of a batch ---------------------------------------------------------------------------------------------
class Sizes(NamedTuple):
    a: np.ndarray  # bytes by id
    b: np.ndarray
    kind: str  # how ids are stored


def sizes_of(a_path: str, b_path: str) -> Sizes:
    tables = tokenizer_a(a_path)[1], tokenizer_b(b_path)[1]
    return Sizes(*(np.array([len(x) for x in t], np.int64) for t in tables), ids_type(*tables))


class Aligned:
    """A batch as one string of bytes: each side's ends are marks over its places, links and groups are counts of marks."""

    def __init__(self, a: list[bytes], b: list[bytes], sizes: Sizes):
        width = np.dtype(sizes.kind).itemsize
        self.a, self.b = (np.frombuffer(b"".join(x), sizes.kind) for x in (a, b))
        self.n_a, self.n_b = (np.array([len(x) // width for x in xs], np.int64) for xs in (a, b))
        self.ends_a, self.ends_b = np.cumsum(sizes.a[self.a]), np.cumsum(sizes.b[self.b])
        total = int(self.ends_a[-1]) if len(self.ends_a) else 0
        self.mark_a, self.mark_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        self.mark_a[self.ends_a] = self.mark_b[self.ends_b] = True
        self.links = np.flatnonzero(self.mark_a | self.mark_b)  # a link ends at each
        self.upto_a, self.upto_b = (np.cumsum(m, dtype=np.int32) for m in (self.mark_a, self.mark_b))
        #: The byte at which each document ends (documents without tokens end where the one before does).
        self.doc_ends = np.concatenate([[0], self.ends_a])[np.cumsum(self.n_a)] if len(a) else np.zeros(0, np.int64)

    def pairs(self) -> np.ndarray:
        """A code per link: B id in the upper half, so that a B id's pairs stand together."""
        at = self.links
        left, right = self.a[self.upto_a[at] - self.mark_a[at]], self.b[self.upto_b[at] - self.mark_b[at]]
        return right.astype(np.int64) << 32 | left

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums over each document's links (exact in 64-bit integers)."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return np.diff(total[np.searchsorted(self.links, self.doc_ends, side="right")], prepend=0)

    def groups(self, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, list[str]]:
        """Per document the number of groups and the digest of ``a1,a2|b1;a3|b2``."""
        both = self.mark_a & self.mark_b
        ends = np.flatnonzero(both)
        n_groups = np.diff(np.searchsorted(ends, self.doc_ends, side="right"), prepend=0)
        # order of writing: by group, A before B, by place
        group_a, group_b = np.searchsorted(ends, self.ends_a), np.searchsorted(ends, self.ends_b)
        before_b = np.concatenate([[0], self.upto_b[ends]])
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + before_b[group_a]] = 3 * self.a.astype(np.int64) + both[self.ends_a]
        codes[np.arange(len(self.b)) + self.upto_a[ends][group_b]] = 3 * self.b.astype(np.int64) + 2 * both[self.ends_b]
        text, size = digits[0][codes], digits[1][codes]
        flat = text[np.arange(text.shape[1]) < size[:, None]].tobytes()
        stops = np.concatenate([[0], np.cumsum(size)])[np.cumsum(self.n_a + self.n_b)].tolist() if len(self.n_a) else []
        digests, at = [], 0
        for stop in stops:
            digests.append(hashlib.sha256(flat[at : stop - 1]).hexdigest() if stop > at else "")
            at = stop
        return n_groups, digests


def digit_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and length of every id with each of the signs , | ; behind it, at 3 * id + sign."""
    words = [f"{i}{s}".encode() for i in range(n) for s in ",|;"]
    width = max(map(len, words))
    text = np.frombuffer(b"".join(w.ljust(width) for w in words), np.uint8).reshape(len(words), width)
    return text, np.array([len(w) for w in words], np.int64)


def counted(pairs: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and how often each occurs (by ``weights``)."""
    at, distinct = pd.factorize(pairs)
    if weights is None:
        return distinct, np.bincount(at, minlength=len(distinct))
    summed = np.zeros(len(distinct), np.int64)
    np.add.at(summed, at, weights)
    return distinct, summed


def _pair_counts(sizes: Sizes, limit: int = 1 << 20):
    """Distinct pairs of a task with their counts; handed on when ``limit`` are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for k in range(0, len(keys), CHUNK):
                some = keys[k : k + CHUNK]
                fields = part_of(some), some, counts[k : k + CHUNK]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in fields], names=["part", "pair", "n"])

        for batch in batches:
            found, n = counted(Aligned(*(batch.column(k).to_pylist() for k in (0, 1)), sizes).pairs())
            keys, counts = counted(np.concatenate([keys, found]), np.concatenate([counts, n]))
            if len(keys) > limit:
                yield from out()
                keys, counts = keys[:0], counts[:0]
        yield from out()

    return run


# -- minimal perfect hash ---------------------------------------------------------------------------------------------
def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix (splitmix's finaliser) of ``keys`` under ``seed``."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def part_of(pairs: np.ndarray) -> np.ndarray:
    """The part of a pair's B id."""
    return (mixed(pairs >> 32, 1 << 16) % np.uint64(PARTS)).astype(np.int64)


class PerfectHash:
    """Levels of bits over distinct keys: the index of a key is the rank of its bit among all levels' set bits."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, below = [], 0
        for bits in levels:
            rank = np.cumsum(bits, dtype=np.int64) - bits + below
            below += int(bits.sum())
            self.ranks.append(rank)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = np.uint64(GAMMA * len(keys) + 1)
            at = (mixed(keys, len(levels)) % size).astype(np.int64)
            alone = np.bincount(at, minlength=int(size)) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; of a key not built in some index or -1, so the caller compares keys."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mixed(keys[todo], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        return out

    def dump(self) -> tuple[list[int], bytes]:
        return [len(x) for x in self.levels], b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def read(cls, sizes: list[int], packed: bytes) -> PerfectHash:
        levels, at = [], 0
        for n in sizes:
            step = (n + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(packed, np.uint8, step, at), count=n).astype(bool))
            at += step
        return cls(levels)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's hash from its distinct pairs, with the keys at their indexes."""
    got = [(b.column("shard")[0].as_py(), b.column("pair").to_numpy()) for b in batches if b.num_rows]
    shard, keys = got[0][0], np.concatenate([x for _, x in got])
    mph = PerfectHash.build(keys)
    ordered = np.empty_like(keys)
    ordered[mph.index(keys)] = keys
    sizes, packed = mph.dump()
    yield pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int64()), pa.array([len(keys)], pa.int64()), pa.array([sizes], pa.list_(pa.int64())),
         pa.array([packed], pa.binary()), pa.array([ordered.tobytes()], pa.binary())],
        names=["shard", "size", "sizes", "packed", "pairs"],
    )


class Block:
    """The hashes of consecutive shards with the keys at their indexes; the shards' indexes follow one another."""

    def __init__(self, rows: list, width: int):
        self.width = width  # parts of a shard
        self.hashes = {r.shard: PerfectHash.read(list(r.sizes), bytes(r.packed)) for r in rows}
        starts = np.cumsum([0, *(r.size for r in rows)]).tolist()
        self.start = {r.shard: k for r, k in zip(rows, starts, strict=False)}
        self.pairs = np.concatenate([np.frombuffer(bytes(r.pairs), np.int64) for r in rows])

    def index(self, pairs: np.ndarray) -> np.ndarray:
        """The index of each distinct pair, -1 where the block doesn't have it: the key at the index must be the pair."""
        shard = part_of(pairs) // self.width
        out = np.full(len(pairs), -1, np.int64)
        order = np.argsort(shard, kind="stable")
        names, first = np.unique(shard[order], return_index=True)
        for name, at in zip(names.tolist(), np.split(order, first[1:]), strict=True):
            if name in self.hashes:
                found = self.hashes[name].index(pairs[at])
                out[at] = np.where(found >= 0, found + self.start[name], -1)
        held = out >= 0
        out[held] = np.where(self.pairs[out[held]] == pairs[held], out[held], -1)
        return out


def _dense(shared):
    """A task's dense count vector over the block's indexes, in rows of CHUNK entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        vector = np.zeros(len(block.pairs), np.int64)
        for batch in batches:
            pairs, n = (batch.column(k).to_numpy() for k in (0, 1))
            np.add.at(vector, block.index(pairs), n)
        team = TaskContext.get().partitionId()
        for k in range(0, len(vector), CHUNK):
            fields = [pa.array([team], pa.int64()), pa.array([k // CHUNK], pa.int64()), pa.array([vector[k : k + CHUNK].tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(fields, names=["team", "chunk", "vector"])

    return run


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, team, chunk = None, 0, 0
    for batch in batches:
        for team, chunk, vector in zip(*(batch.column(c).to_pylist() for c in ("team", "chunk", "vector")), strict=True):
            values = np.frombuffer(vector, np.int64)
            total = values.copy() if total is None else total + values
    fields = [pa.array([team // FAN_IN], pa.int64()), pa.array([chunk], pa.int64()), pa.array([total.tobytes()], pa.binary())]
    yield pa.RecordBatch.from_arrays(fields, names=["team", "chunk", "vector"])


def tree_sum(vectors: DataFrame, teams: int) -> np.ndarray:
    """The sum of ``teams`` vectors: FAN_IN of them at a time, until one is left."""
    while teams > 1:
        vectors = vectors.groupBy(F.floor(F.col("team") / FAN_IN), "chunk").applyInArrow(_sum, "team long, chunk long, vector binary")
        teams = -(-teams // FAN_IN)
    rows = sorted(vectors.select("chunk", "vector").collect())
    return np.concatenate([np.frombuffer(bytes(v), np.int64) for _, v in rows])


DIGEST = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)


def _look_up(shared, sizes: Sizes, first: bool):
    """Second pass: align again; per document the sums over its links that the block holds, and (``first``) the counts of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts, best = shared.value
        digits = digit_table(max(len(sizes.a), len(sizes.b))) if first else None
        for batch in batches:
            aligned = Aligned(*(batch.column(k).to_pylist() for k in (2, 3)), sizes)
            back, distinct = pd.factorize(aligned.pairs())
            at = block.index(distinct)
            count = np.where(at >= 0, counts[at], 0)[back] if len(at) else back
            is_best = np.where(at >= 0, best[at], False)[back] if len(at) else back
            none = np.zeros(batch.num_rows, np.int64)
            n_groups, digests = aligned.groups(digits) if first else (none, [None] * batch.num_rows)
            own = (aligned.n_a, aligned.n_b, n_groups, aligned.per_doc(np.ones(len(aligned.links), np.int64))) if first else (none,) * 4
            sums = aligned.per_doc(is_best), aligned.per_doc(count)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (*own, *sums)), pa.array(digests, pa.string())], schema=DIGEST
            )

    return run


def is_best(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id (all pairs of a B id are in one block)."""
    b = pairs >> 32
    order = np.argsort(b, kind="stable")
    starts = np.flatnonzero(np.append(True, b[order][1:] != b[order][:-1])) if len(b) else np.zeros(0, np.int64)
    out = np.zeros(len(b), bool)
    if len(b):
        top = np.maximum.reduceat(counts[order], starts)
        out[order] = counts[order] == np.repeat(top, np.diff(np.append(starts, len(b))))
    return out


# -- the whole job ----------------------------------------------------------------------------------------------------
def encoded(docs: DataFrame, a_path: str = A_FILE, b_path: str = B_FILE) -> DataFrame:
    """(row, doc_id, a, b): both tokenizers' ids of each document, written once."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return written(rows.mapInArrow(_encode(a_path, b_path), "row long, doc_id long, a binary, b binary"), "ids", "zstd")


def pair_counts(tokens: DataFrame, sizes: Sizes, shard_pairs: int = SHARD_PAIRS, block_pairs: int = BLOCK_PAIRS):
    """Yields (block, counts, is_best) over all distinct pairs: at most ``block_pairs`` at a time (one shard may hold more)."""
    spark = tokens.sparkSession
    partials = written(tokens.select("a", "b").mapInArrow(_pair_counts(sizes), "part long, pair long, n long"), "partials", "zstd")
    keys = written(partials.select("part", "pair").distinct(), "pairs")
    n_keys, n_partials = keys.count(), partials.count()
    width = max(1, PARTS // max(1, -(-n_keys // shard_pairs)))  # parts of a shard
    by_shard = keys.select(F.floor(F.col("part") / width).alias("shard"), "pair").groupBy("shard")
    hashes = written(by_shard.applyInArrow(_build, "shard long, size long, sizes array<long>, packed binary, pairs binary"), "hashes")
    blocks, held = [], 0
    for shard, size in sorted(hashes.select("shard", "size").collect()):  # PARTS rows at most
        if not blocks or held + size > block_pairs:
            blocks.append([])
            held = 0
        blocks[-1].append(shard)
        held += size
    for names in blocks:
        block = Block(hashes.filter(F.col("shard").between(names[0], names[-1])).orderBy("shard").collect(), width)
        shared = spark.sparkContext.broadcast(block)
        some = partials.filter(F.col("part").between(names[0] * width, (names[-1] + 1) * width - 1)).select("pair", "n")
        # a reader takes in at least twice as many entries as its vector has
        readers = max(1, -(-n_partials // (2 * n_keys)))
        some = some.coalesce(readers)
        counts = tree_sum(some.mapInArrow(_dense(shared), "team long, chunk long, vector binary"), readers)
        shared.destroy()
        yield block, counts, is_best(block.pairs, counts)


def report(docs: DataFrame, a_path: str = A_FILE, b_path: str = B_FILE, **limits) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    prepare(spark)
    sizes = sizes_of(a_path, b_path)
    tokens, results = encoded(docs, a_path, b_path), []
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    for found in pair_counts(tokens, sizes, **limits):
        shared = spark.sparkContext.broadcast(found)
        results.append(tokens.mapInArrow(_look_up(shared, sizes, not results), schema))
        if len(results) > 1:  # one block is held at a time
            results[-1] = written(results[-1], "block")
    if not results:  # no document has tokens
        zeros = [F.lit(0).cast("long").alias(f.name) for f in DIGEST if f.name.startswith(("n_", "count"))]
        return tokens.select("doc_id", *zeros, F.lit("").alias("groups_sha256"))
    out = results[0]
    if len(results) > 1:
        for more in results[1:]:
            out = out.unionByName(more)
        sums = [F.sum(f.name).alias(f.name) for f in DIGEST if f.name.startswith(("n_", "count"))]
        out = out.groupBy("row", "doc_id").agg(*sums, F.max("groups_sha256").alias("groups_sha256"))
    return out.drop("row")
