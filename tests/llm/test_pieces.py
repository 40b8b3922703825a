"""Operators 1 and 7 against the library's own unigram lattice over the same vocabulary, and against brute force."""

import hashlib
import itertools
import random
from array import array

import pytest
import sentencepiece

from panelcast.llm import nbest as N
from panelcast.llm import pieces as P
from panelcast.llm import token_count as T

from .fixtures import corpus, empty, frame


@pytest.fixture(scope="module")
def v():
    return P.load(N.MODEL)


@pytest.fixture(scope="module")
def library():
    """The vocabulary file with its trainer's model type (field 3) set to unigram: the library then builds a lattice."""
    data = open(N.MODEL, "rb").read()
    mark = b"\x12\x06tok_v0\x18"
    at = data.index(mark) + len(mark)
    return sentencepiece.SentencePieceProcessor(model_proto=data[:at] + b"\x01" + data[at + 1 :])


def score(v, ids):
    first = v.byte_ids[0]
    chars = bytes(i - first for i in ids if first <= i <= v.byte_ids[255]).decode()
    return sum(v.pieces[v.text[i]][1] for i in ids if not first <= i <= v.byte_ids[255]) + v.unknown_score * len(chars)


def texts(v):
    rng = random.Random(1)
    known = [c for c in "abtheonrisE.,é" if c in v.pieces]
    out = ["Hello world", "a", "the", "to the.", "an other thing, and then another", "zzzzzzzz"]
    return out + ["".join(rng.choice(known + [" "]) for _ in range(rng.randint(1, 25))).strip().replace("  ", " ").replace("  ", " ") or "a" for _ in range(150)]


def test_scores_equal_the_library(v, library):
    # without unknown characters: their scores are beyond the exact range of the library's 32-bit sums
    e, c = N.Encoder(v, 4), T.Counter(v)
    for t in texts(v):
        got = e.encode(t)
        theirs = library.nbest_encode(t, nbest_size=4)
        assert [s for s, _ in got] == [score(v, ids) for ids in theirs], t
        assert all(score(v, ids) == s for s, ids in got)
        assert c.text(t) == (len(got[0][1]), got[0][0])


def all_paths(v, s):
    """Every segmentation of a chunk, best first; of equal ones the one whose last piece starts first."""
    out = []

    def walk(at, path, total):
        if at == len(s):
            out.append((total, path))
            return
        single = False
        for end in range(at + 1, len(s) + 1):
            p = v.pieces.get(s[at:end])
            if p:
                single |= end == at + 1
                walk(end, (*path, (at, end, p[0])), total + p[1])
        if not single:
            walk(at + 1, (*path, (at, at + 1, -1)), total + v.unknown_score)

    walk(0, (), 0.0)
    return sorted(out, key=lambda x: (-x[0], [p[0] for p in reversed(x[1])]))


@pytest.mark.parametrize("s", ["▁the", "▁ting", "▁▁▁a", "▁é日n", "日本", "▁therein", "▁", "a\nb"])
def test_chunk_search_is_exhaustive(v, s):
    paths = all_paths(v, s)
    found = N.search(v, s, 8)
    assert [x[0] for x in found] == [x[0] for x in paths[:8]]
    assert len({x[1] for x in found}) == len(found)
    best, ids, loss = N.best_of(v, s)
    assert (best, ids) == found[0]
    assert loss == (paths[0][0] - paths[1][0] if len(paths) > 1 else float("inf"))
    assert T.Counter(v).chunk(s) == (best, len(ids))


def test_tie_goes_to_the_last_piece_that_starts_first():
    v = P.Vocabulary({"a": (0, -1.0), "b": (1, -1.0), "ab": (2, -2.0), "c": (3, -1.0), "bc": (4, -2.0), "▁": (5, 0.0)}, ["a", "b", "ab", "c", "bc", "▁"], [], 9, -99.0, 2)
    assert N.best_of(v, "abc") == (-3.0, (0, 4), 0.0)
    assert N.best_of(v, "abc", P.piece_automaton(v))[:2] == (-3.0, (0, 4))
    assert T.Counter(v).chunk("abc") == (-3.0, 2)
    assert T.Counter(v).chunk("xab")[1] == 2  # x is unknown, then ab


def test_whole_text_n_best_is_exact(v):
    for t in ["the tin", "an at", "is it"]:
        parts = P.chunks(t)
        every = sorted((sum(x[0] for x in c) for c in itertools.product(*[all_paths(v, s) for s in parts])), reverse=True)
        got = N.Encoder(v, 6).encode(t)
        assert [s for s, _ in got] == every[: len(got)] and len(got) == min(6, len(every))
        assert len({tuple(i) for _, i in got}) == len(got)


def test_round_trip(v):
    e, d = N.Encoder(v, 3), N.Decoder(v)
    for t in ["", " ", "  two  blanks ", "tab\tand\nline", "日本語 𝄞 é", "x" * 500, "\U0001f600\u200d", "\x00\x7f"]:
        assert all(d(ids) == t for _, ids in e.encode(t))
    assert d(e.encode("a▁b")[0][1]) == "a b"


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "MEMO", 5)
    m = P.Memo(lambda s: s.upper())
    assert [m[str(i)] for i in range(40)] == [str(i) for i in range(40)]
    assert len(m) <= 5 and len(m.old) <= 5 and m["x" * 99] == "X" * 99 and "x" * 99 not in m


def test_queries(spark, v):
    rows = corpus()
    got = N.report(frame(spark, rows)).collect()
    counts = T.count(frame(spark, rows)).collect()
    e = N.Encoder(v, N.N_BEST)
    assert len(got) == len(counts) == len(rows)
    want = []
    for i, t, _ in rows:
        best = e.encode(t)
        want.append((i, len(best[0][1]), best[0][0], [s for s, _ in best], [hashlib.sha256(array("i", x).tobytes()).hexdigest() for _, x in best], True, best[0][1]))
    key = lambda r: (str(r[0]), str(r[1:]))
    assert sorted([tuple(r) for r in got], key=key) == sorted(want, key=key)
    assert sorted([tuple(r) for r in counts], key=key) == sorted([w[:3] for w in want], key=key)


def test_encode_and_decode_frames(spark):
    rows = [(1, "Hello world", "en"), (2, "", "en"), (3, None, "en")]
    enc = N.encode(frame(spark, rows), n=2)
    assert {r["doc_id"]: len(r["segmentations"]) for r in enc.collect()} == {1: 2, 2: 1, 3: 1}
    assert {r["doc_id"]: r["text"] for r in N.decode(enc).collect()} == {1: "Hello world", 2: "", 3: ""}


def test_empty_tables(spark):
    assert N.report(empty(spark)).count() == 0
    assert T.count(empty(spark)).count() == 0
