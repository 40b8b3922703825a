"""Operator 2: base counts and the language model against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from panelcast.llm import ngram_quality as Q
from panelcast.llm import queries

from .fixtures import corpus, empty, frame, vocabulary, words


def brute_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times = Counter(wins)
    hit = {i + j for i, x in enumerate(wins) if times[x] > 1 for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


@pytest.mark.parametrize(
    "text",
    [None, "", " \n ", "a", "a b c d e a b c d e", "a a a a a a a a", "x\nx\n\ny\nx", "a b c d e f\na b c d e f", "#*$ %&| <> é日", "a\x0bb\x0cc\xa0d"],
)
def test_base_counts(text):
    assert Q.base_counts(text) == brute_base(text)


def brute_model(docs):
    """lang -> gram -> log probability, by the textbook recursion over dictionaries."""
    out = {}
    for lang in {g for _, g in docs}:
        top = Counter()
        for t, g in docs:
            if g == lang:
                top.update(Q.ngram_keys(t).tolist())
        b = Q.SYMBOL_BITS
        levels = {Q.ORDER: dict(top)}
        for k in range(Q.ORDER - 1, 0, -1):
            levels[k] = dict(Counter(x & ((1 << (b * k)) - 1) for x in levels[k + 1]))
        prob = {}
        for k in range(1, Q.ORDER + 1):
            a = levels[k]
            n = [sum(v == i for v in a.values()) for i in range(5)]
            d = [0.0, 0.5, 1.0, 1.5]
            if all(n[1:]):
                y = n[1] / (n[1] + 2 * n[2])
                for i in (1, 2, 3):
                    x = i - (i + 1) * y * n[i + 1] / n[i]
                    d[i] = x if 0 < x <= i else d[i]
            groups = defaultdict(list)
            for x, c in a.items():
                groups[x >> b].append(c)
            new = {}
            for x, c in a.items():
                cs = groups[x >> b]
                gamma = sum(d[min(v, 3)] for v in cs) / sum(cs)
                low = 1 / (len(cs) + 1) if k == 1 else prob[x & ((1 << (b * (k - 1))) - 1)]
                new[x] = max(c - d[min(c, 3)], 0) / sum(cs) + gamma * low
            prob = new
        out[lang] = ({x: math.log(p) for x, p in prob.items()}, levels[Q.ORDER])
    return out


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    return rows, Q.score(frame(spark, rows)).collect()


def test_verdicts_match_brute_force(scored):
    rows, got = scored
    assert len(got) == len(rows)
    model = brute_model([(t, g or "") for _, t, g in rows if t is not None])
    bands = {}
    for lang, (lp, n) in model.items():
        w = sum(n.values())
        mean = -sum(n[x] * lp[x] for x in n) / w
        bands[lang] = mean, math.sqrt(max(sum(n[x] * lp[x] ** 2 for x in n) / w - mean**2, 0))
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for i, t, g in rows:
        base = brute_base(t)
        r = next(r for r in by[i] if (r["n_words"], r["word_chars"]) == base[:2])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        assert r["base_failed"] == failed
        if not t:
            assert r["perplexity"] is None and not r["kept"]
            continue
        keys = Q.ngram_keys(t).tolist()
        h = -sum(model[g or ""][0][k] for k in keys) / len(keys)
        assert math.log(r["perplexity"]) == pytest.approx(h, abs=0.02)  # slots may be shared
        mean, std = bands[g or ""]
        short = Q.BAND_SHORT / math.sqrt(len(keys))
        lo, hi = mean - std * (Q.BAND_LOW + short), mean + std * (Q.BAND_HIGH + short)
        if min(abs(h - lo), abs(h - hi)) > 0.03:
            assert r["kept"] == (not failed and lo <= h <= hi)


def test_probabilities_of_a_context_sum_to_less_than_one():
    (lp, _), *_ = brute_model([("the cat sat on the mat", "en")]).values()
    sums = defaultdict(float)
    for k, v in lp.items():
        sums[k >> Q.SYMBOL_BITS] += math.exp(v)
    assert all(0 < s <= 1 + 1e-9 for s in sums.values())


def test_estimate_equals_brute_force(spark):
    rows = [(i, t, g) for i, t, g in corpus(2, 20)[:20]]
    got = Q.estimate(Q.count_ngrams(frame(spark, rows))).collect()
    model = brute_model([(t, g or "") for _, t, g in rows])
    assert len(got) == sum(len(m[0]) for m in model.values())
    assert all(abs(r["logp"] - model[r["lang"]][0][r["key"]]) < 1e-9 for r in got)


def test_filter_keeps_columns_and_rows(spark, scored):
    rows, got = scored
    kept = Q.filter_documents(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert kept.count() == sum(r["kept"] for r in got)


def test_junk_goes(spark):
    # random bytes of letters beside regular text
    import random

    rng = random.Random(4)
    rows = [(i, t, "en") for i, (_, t, _) in enumerate(corpus(5, 60)[:60]) if len(t) > 200]
    noise = " ".join("".join(rng.choice("qxzvkjw#%&") for _ in range(8)) for _ in range(80))
    got = {r["doc_id"]: r["kept"] for r in Q.score(frame(spark, [*rows, (999, noise, "en")])).collect()}
    assert not got[999] and sum(got.values()) >= 0.95 * len(rows)


def test_empty_table(spark):
    assert Q.score(empty(spark)).count() == 0
    assert Q.filter_documents(empty(spark)).count() == 0


def op2(spark, folder, rows):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    return queries.op2_ngram_quality(spark, str(folder)).collect()


def test_clean_documents_stay_beside_a_text_copied_to_a_third_of_the_rows(spark, tmp_path):
    rng = random.Random(6)
    v = vocabulary(rng, 2000)
    rows = [(i, words(rng, rng.randint(30, 150), v), "en") for i in range(400)]
    copied = words(rng, 400, v)
    rows += [(1000 + i, copied, "en") for i in range(200)]
    kept = {r["doc_id"]: r["kept"] for r in op2(spark, tmp_path, rows)}
    assert sum(kept[i] for i in range(400)) >= 0.97 * 400
    assert all(kept[1000 + i] for i in range(200))
