"""Operator 10 against brute force."""

import re

import numpy as np
import pytest

from panelcast.llm import components as C
from panelcast.llm import minhash as M

from .fixtures import corpus, empty, frame, vocabulary, words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, threshold):
    """Component of each row by union-find over all pairs of rows."""
    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= threshold * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = [find(i) for i in range(len(rows))]
    out = []
    for i, (doc_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if groups[j] == groups[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids and sets[i] else doc_id))
    return out


def chain(seed=3):
    """A hub whose copies differ by one to six words, and a chain of steps: stars alone would miss links."""
    import random

    rng = random.Random(seed)
    v = vocabulary(rng)
    hub = words(rng, 150, v).split(" ")
    rows = []
    for i in range(60):
        w = list(hub)
        for p in rng.sample(range(0, 150), i % 7):
            w[p] = f"new{i}x{p}"
        rows.append((500 + (i * 37) % 60, " ".join(w), "en"))
    step = words(rng, 140, v).split(" ")
    for i in range(12):
        step[i * 11] = f"step{i}"
        rows.append((900 - i, " ".join(step), "en"))
    return rows


@pytest.mark.parametrize("threshold", [80, 85])
@pytest.mark.parametrize("rows", [corpus(), chain()], ids=["corpus", "chain"])
def test_groups_match_brute_force(spark, rows, threshold):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in M.groups(frame(spark, rows), threshold).collect()), key=str)
    assert got == sorted(brute(rows, threshold), key=str)


def test_kept_flag(spark):
    for r in M.groups(frame(spark, corpus())).collect():
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_deduplicate_leaves_one_of_each_group(spark):
    rows = corpus()
    docs = frame(spark, rows)
    left = M.deduplicate(docs)
    assert left.columns == docs.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in left.collect())
    expected, seen = [], set()
    for (i, n, c), (_, t, _) in zip(brute(rows, 80), rows, strict=True):
        if n == 0 or i == c and (c, t) not in seen:
            seen.add((c, t))
            expected.append((i is None, i or 0, t or ""))
    assert got == sorted(expected)


def test_deduplicate_keeps_unrelated_texts_with_null_or_equal_ids(spark):
    import random

    rng = random.Random(11)
    v = vocabulary(rng)
    texts = [words(rng, 40, v) for _ in range(7)]
    rows = [(i, t, "en") for i, t in zip([None, None, None, 5, 5, 5, 6], texts, strict=True)]
    rows += [(None, texts[1], "en"), (9, texts[4], "en"), (None, texts[6], "en")]  # copies
    got = sorted((r["doc_id"] or 0, r["text"]) for r in M.deduplicate(frame(spark, rows)).collect())
    assert got == sorted((i or 0, t) for i, t, _ in rows[:7])


def test_sketch_estimates_similarity():
    rng = np.random.Generator(np.random.PCG64(1))
    pool = rng.integers(0, 2**63, 1200, dtype=np.uint64) * np.uint64(2)
    same = []
    for k in range(40):
        a, b = np.unique(pool[20 * k % 100 : 1000]), np.unique(pool[20 * k % 100 + 100 : 1100])
        same.append(np.mean(M.band_hashes(a) == M.band_hashes(b)))
    # similarity about 0.8, six rows to a band
    assert 0.15 < np.mean(same) < 0.42


def test_small_sets_fill_every_bin():
    bands = M.band_hashes(M.shingle_set("only three words"))
    assert len(bands) == M.BANDS and len(set(bands.tolist())) == M.BANDS


def test_words_with_equal_bytes_differ():
    assert len(np.intersect1d(M.shingle_set("ab c"), M.shingle_set("a bc"))) == 0
    assert (M.shingle_set("A  b\tc") == M.shingle_set("a b c")).all()


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    got = {r["node"]: r["label"] for r in C.components(spark.createDataFrame(path + star + [(7, 7)], "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}


def test_empty_table(spark):
    assert M.groups(empty(spark)).count() == 0
    assert M.deduplicate(empty(spark)).count() == 0
