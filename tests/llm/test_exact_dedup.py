"""Operator 11 against a dictionary of whole texts."""

import hashlib

import pytest

from panelcast.llm import grace_dedup as G

from .fixtures import corpus, empty, frame

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(rows):
    groups = {}
    for k, (i, t, _) in enumerate(rows):
        groups.setdefault(t or "", []).append((i, k))
    out = []
    for k, (i, t, _) in enumerate(rows):
        members = groups[t or ""]
        best = max((m for m, _ in members if m is not None), default=None)
        stays = min(n for m, n in members if m == best)
        out.append((i, best, len(members), k == stays, hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def rows():
    found = corpus(3, 30)
    found += [(500 + i, "one text in a third of all rows", "en") for i in range(40)]
    found += [(700, "same id and text", "en")] * 5 + [(None, "text of null ids", "fr")] * 3 + [(701, "text of null ids", "fr")]
    return found


def same(got, want):
    """Rows that repeat id and text are interchangeable: which of them stays is not compared."""
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"hot": 1},  # every group by the join
        {"combine_bytes": 500, "bucket_bytes": 2_000, "max_files": 2},  # copies in many records, buckets split again and again
        {"bucket_bytes": 5_000, "max_files": 2, "hash_of": lambda body: len(body) % 3},  # equal hashes of different contents
    ],
    ids=["defaults", "no broadcast", "recursion", "collisions"],
)
def test_matches_brute_force(spark, options):
    found = rows()
    got = G.groups(frame(spark, found).repartition(5), **options)
    assert got.columns == COLUMNS
    same(got.collect(), brute(found))


def test_empty_table(spark):
    got = G.groups(empty(spark))
    assert got.columns == COLUMNS and got.count() == 0


def test_deduplicate_keeps_all_columns_and_one_row_a_text(spark):
    docs = frame(spark, rows()).repartition(3)
    got = G.deduplicate(docs)
    assert got.columns == docs.columns
    want = [(i, t or "") for i, t, _ in rows()]
    best = {}
    for i, t in want:
        best[t] = i if best.get(t) is None else best[t] if i is None else max(best[t], i)
    assert sorted(((r.doc_id, r.text or "") for r in got.collect()), key=str) == sorted(((i, t) for t, i in best.items()), key=str)


def test_normalised_texts(spark):
    from pyspark.sql import functions as F

    docs = frame(spark, [(1, "A b", "en"), (2, "a B", "en"), (3, "c", "en")])
    got = {r.doc_id: (r.keep_id, r.group_size) for r in G.groups(docs, normalise=F.lower).collect()}
    assert got == {1: (2, 2), 2: (2, 2), 3: (3, 1)}


def test_table_compares_contents():
    table = G.ContentTable(slots=2)
    for k in range(300):
        table.add(7, b"x%d" % (k % 100), 1, k)
    table.add(7, b"x5", 4, None)
    assert len(table.bodies) == 100 and sum(table.sizes) == 304
    assert table.sizes[5] == 7 and table.best[5] == 205
