"""Operator 9 against brute force, and its guarantee."""

import hashlib
import random
import re

import pytest

from panelcast.llm import winnowing as W

from .fixtures import corpus, empty, frame, vocabulary, words


def tokens(text):
    low = (text or "").translate(str.maketrans(W.UPPER, W.LOWER))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, bench):
    windows = {}
    for i, t in bench:
        w = tokens(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for doc_id, t, _ in rows:
        w, hit, items = tokens(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    items |= windows[tuple(w[k : k + n])]
        ids = sorted(str(i) for i in items if i is not None)
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(9)
    v = vocabulary(rng)
    bench = [(i, words(rng, n, v)) for i, n in enumerate([30, 13, 14, 60, 12, 7, 3, 1, 40])]
    bench += [(20, bench[0][1]), (21, None), (22, ""), (23, "..."), (None, words(rng, 20, v)), (24, "Mixed CASE École, words; and (signs) " + words(rng, 12, v))]
    rows = corpus()
    for k, (i, t) in enumerate(bench):
        w = (t or "").split(" ")
        for cut in (0, 1, len(w) // 2):  # whole, without the first word, a half
            rows.append((200 + 10 * k + cut, words(rng, 15, v) + ". " + " ".join(w[cut:]).upper() + ", " + words(rng, 25, v), "en"))
    rows.append((400, " ".join([bench[3][1]] * 3), "en"))
    rows.append((401, words(rng, 2000, v) + " " + bench[0][1], "en"))
    return rows, bench


def test_report_matches_brute_force(spark, case):
    rows, bench = case
    b = spark.createDataFrame([(i, t, "clash") for i, t in bench], "item_id long, text string, th string")
    got = [tuple(r) for r in W.report(frame(spark, rows), b).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, bench), key=str)


def test_decontaminate(spark, case):
    rows, bench = case
    b = spark.createDataFrame(bench, "item_id long, text string")
    docs = frame(spark, rows)
    left = W.decontaminate(docs, b)
    assert left.columns == docs.columns
    assert left.count() == sum(not r[-1] for r in brute(rows, bench))


@pytest.mark.parametrize("span", [13, 6, 2])
def test_every_shared_span_shares_a_fingerprint(spark, span):
    rng = random.Random(span)
    v = vocabulary(rng, 30)
    shared = words(rng, span, v)
    texts = [(i, words(rng, rng.randint(0, 20), v) + " " + shared + " " + words(rng, rng.randint(0, 20), v)) for i in range(30)]
    df = spark.createDataFrame(texts, "id long, __text string")
    f = W._all_fingerprints(df, [span], ["id"]).collect()
    by = {}
    for r in f:
        by.setdefault(r["id"], set()).add(r["fp"])
    assert all(by[0] & by[i] for i in by) and len(by) == 30


def test_empty_tables(spark):
    b = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert W.report(empty(spark), b).count() == 0
    none = W.report(frame(spark, corpus()), b.limit(0)).collect()
    assert len(none) == len(corpus()) and not any(r["contaminated"] or r["n_hit"] or r["n_items"] for r in none)
