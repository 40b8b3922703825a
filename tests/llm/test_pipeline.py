"""The pipeline against the composition of the operators' brute-force versions."""

import hashlib
import importlib
import math
import random
from array import array

import pytest

from panelcast.llm import nbest as N
from panelcast.llm import ngram_quality as Q
from panelcast.llm import pieces as P

from .fixtures import corpus, frame, vocabulary, words
from .test_decontamination import brute as contaminated
from .test_near_duplicates import brute as grouped
from .test_quality_rules import brute_base, brute_model
from .test_secrets import base_spans

corpus_pipeline = importlib.import_module("corpus_pipeline")


def documents():
    rng = random.Random(12)
    v = vocabulary(rng)
    rows = [r for r in corpus(7, 60) if r[0] is None or r[0] < 100]
    bench = [(1, words(rng, 30, v)), (2, words(rng, 20, v))]
    rows += [(300 + i, words(rng, 30, v) + " " + bench[i % 2][1], "en") for i in range(4)]
    rows += [(320 + i, words(rng, 60, v) + f' token = "{rng.randbytes(20).hex()}" ' + words(rng, 20, v), "fr") for i in range(4)]
    rows += [(340, "short text", "en"), (341, "same words again " * 20, "en"), (3, rows[3][1], rows[3][2])]
    return rows, bench


def brute(rows, bench):
    model = brute_model([(t, g or "") for _, t, g in rows if t is not None])
    kept = []
    for i, t, g in rows:
        b = brute_base(t)
        if b[0] < 10 or 100 * b[4] > 20 * b[0]:
            continue
        lp, n = model[g or ""]
        w = sum(n.values())
        mean = -sum(n[x] * lp[x] for x in n) / w
        std = math.sqrt(max(sum(n[x] * lp[x] ** 2 for x in n) / w - mean**2, 0))
        keys = Q.ngram_keys(t).tolist()
        h = -sum(lp[k] for k in keys) / len(keys)
        short = Q.BAND_SHORT / math.sqrt(len(keys))
        lo, hi = mean - std * (Q.BAND_LOW + short), mean + std * (Q.BAND_HIGH + short)
        assert min(abs(h - lo), abs(h - hi)) > 0.01, "a borderline document says nothing"
        if lo <= h <= hi:
            kept.append((i, t, g))
    seen, single = set(), []
    for (i, _, c), (_, t, g) in zip(grouped(kept, 80), kept, strict=True):
        if i == c and c not in seen:
            seen.add(c)
            single.append((i, t, g))
    clean = [r for r, x in zip(single, contaminated(single, bench), strict=True) if not x[-1]]
    encoder = N.Encoder(P.load(N.MODEL), N.N_BEST)
    out = []
    for i, t, _ in clean:
        text, at = "", 0
        for a, _, _, b in base_spans(t):
            if a >= at:
                text += t[at:a] + "[secret]"
            at = max(at, b)
        best = encoder.encode(text + t[at:])
        out.append((i, len(best[0][1]), best[0][0], [s for s, _ in best], [hashlib.sha256(array("i", x).tobytes()).hexdigest() for _, x in best], True, best[0][1]))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, bench = documents()
    path = str(tmp_path_factory.mktemp("corpus"))
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_run_matches_brute_force(spark, folder):
    want = brute(*documents())
    got = [tuple(r) for r in corpus_pipeline.run(spark, folder).collect()]
    assert 20 < len(want) < len(documents()[0]) - 10
    assert sorted(got, key=str) == sorted(want, key=str)


def test_stages(spark, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontamination", "secret_scan", "encoding"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, folder)
        assert out.count() == 0
        if name != names[-1]:
            assert out.columns == docs.columns
