"""Operator 13 against a recursive version."""

import hashlib
import zlib

import pytest

from panelcast.llm import merkle as M

from .fixtures import corpus, empty, frame


def H(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(i, source, lang, n, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def tree(nodes):
    """(root, siblings of each leaf from the bottom up as (side, digest))."""
    ways, spans = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, up_spans = [], []
        for k in range(0, len(nodes), 2):
            run = nodes[k : k + 2]
            for j, span in enumerate(spans[k : k + 2]):
                for leaf_no in span:
                    ways[leaf_no].append(("L", run[0]) if j else ("R", run[1]) if len(run) == 2 else ("", ""))
            up.append(H(*run))
            up_spans.append([x for s in spans[k : k + 2] for x in s])
        nodes, spans = up, up_spans
    return nodes[0], ways


def brute(rows):
    by_lang = {}
    for i, t, g in rows:
        n = None if t is None else len(t)
        hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
        own = leaf(i, "src", g, n, t)
        by_lang.setdefault(g, []).append((i is not None, i or 0, own, leaf(i, "src", g, n + 1, t) if hit else own, i))
    names = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(by_lang[g])]) for g in names}
    root, tops = tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops, strict=True):
        for (_, _, own, held, i), way in zip(sorted(by_lang[g]), trees[g][1], strict=True):
            node = held
            for side, other in [*way, *top]:
                node = H(other, node) if side == "L" else H(node, other)
            out.append((i, own, trees[g][0], root, H(*(d for _, d in [*way, *top])), node, node == root))
    return out


def rows():
    return corpus(5, 60) + [(i, f"text {i}", "de") for i in range(200, 333)] + [(900, "alone", "zz"), (901, "é", "é"), (902, "", "")]


@pytest.mark.parametrize("tier", [1, 3, 10])
def test_matches_brute_force(spark, tier):
    got = M.report(frame(spark, rows()).repartition(4), tier=tier)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found, want = [tuple(r) for r in got.collect()], brute(rows())
    assert sorted(found, key=str) == sorted(want, key=str)
    assert 0 < sum(not r[-1] for r in found) < len(found) / 4


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8])
def test_small_trees(spark, n):
    some = [(i, f"t{i}", "en") for i in range(n)]
    assert sorted(map(tuple, M.report(frame(spark, some), tier=2).collect())) == sorted(brute(some))


def test_many_groups(spark):
    some = [(i, f"t{i}", f"g{i:03}") for i in range(70)]
    assert sorted(map(tuple, M.report(frame(spark, some), tier=3).collect())) == sorted(brute(some))


def test_empty_table(spark):
    assert M.report(empty(spark)).count() == 0


def test_proofs_fold_to_the_root(spark):
    found = M.manifest(frame(spark, rows())).collect()
    assert all(r.verified for r in found)
    r = max(found, key=lambda x: len(x.steps))
    node = r.leaf
    for s in r.steps:
        node = H(s[1:], node) if s[:1] == "L" else H(node, s[1:])
    assert node == r.root
