"""Operators 3 to 6: fixtures worked out by hand, and accuracy on held-out rows."""

import random
import zlib

import duckdb
import pytest

from panelcast.llm import queries as Q
from panelcast.llm import quotes, random_indexing, toxicity, url_filter

from .fixtures import empty, frame, vocabulary, words

SF = "/root/testdata/sf0.001"


# -- 3: quotation linking ---------------------------------------------------------
TALK = [
    (1, 0, "user", "Hello there, how are you today?\nI have a question about Spark."),
    (1, 1, "assistant", "On Monday the user wrote:\n> Hello there, how are you today?\n\nFine, thank you very much.\nAsk away, please do."),
    (1, 2, "user", ">> Hello there, how are you today?\n> Fine, thank you  VERY much.\n> Ask away, please do.\nWhy is the join slow here?"),
    (1, 3, "user", "unrelated new thread of messages"),
    (1, 4, "assistant", "> unrelated new thread of messages\nyes indeed it is so"),
    (1, 5, "assistant", "> Why is the join slow here?\nBecause of the skewed keys."),
    (1, 6, "user", "> something nobody ever said\nhm what about it"),
    (1, 3, "user", "unrelated new thread of messages"),
    (2, None, None, None), (2, 0, "user", "> Hello there, how are you today?"), (2, 1, "user", "> a later message, quoted too early"),
    (2, 2, "user", "a later message, quoted too early"), (None, 0, "user", ""), (3, 0, "user", "x\r\n> \r\n>> > deep quote of nothing"),
]


@pytest.fixture(scope="module")
def linked(spark):
    df = spark.createDataFrame([(*r, "clash", 1) for r in TALK], "conv_id long, turn long, role string, text string, body string, id int")
    return quotes.link(df).collect()


def test_links_and_order(linked):
    assert len(linked) == len(TALK)
    got = sorted([r for r in linked if r["conv_id"] == 1], key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(1, 9))
    assert [(r["turn"], r["parent_turn"], r["root_turn"], r["depth"]) for r in got] == [
        (0, None, 0, 0), (1, 0, 0, 1), (2, 1, 0, 2), (5, 2, 0, 3), (3, None, 3, 0), (3, None, 3, 0), (4, 3, 3, 1), (6, None, 6, 0),
    ]


def test_bodies_have_no_quotes(linked):
    by = {(r["conv_id"], r["turn"]): r for r in linked}
    assert by[1, 1]["body"] == "Fine, thank you very much.\nAsk away, please do."
    assert by[1, 2]["body"] == "Why is the join slow here?" and by[1, 2]["quote_levels"] == 2
    assert by[3, 0]["body"] == "x" and by[3, 0]["quote_levels"] == 3
    assert by[2, None]["body"] == "" and by[None, 0]["body"] == ""


def test_counts_and_no_link_across_conversations_or_backwards(linked):
    by = {(r["conv_id"], r["turn"]): r for r in linked}
    assert (by[1, 2]["n_quoted"], by[1, 2]["n_linked"]) == (2, 2)
    assert (by[1, 6]["n_quoted"], by[1, 6]["n_linked"]) == (1, 0)
    assert by[2, 0]["n_linked"] == 0 and by[2, 1]["n_linked"] == 0


def test_long_conversation_is_numbered_by_blocks(spark):
    rows = [(7, i, "user", f"message number {i} of the long talk" + (f"\n> message number {i - 300} of the long talk" if i % 5 == 0 and i >= 300 else "")) for i in range(1500)]
    got = sorted(quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(1, 1501))
    root = {}
    for i in range(1500):
        root[i] = root[i - 300] if i % 5 == 0 and i >= 300 else i
    assert [r["turn"] for r in got] == sorted(range(1500), key=lambda i: (root[i], i))


def test_short_passages_are_linked_and_counted(spark):
    rows = [(1, 0, "user", "Thanks!"), (1, 1, "user", "今日は。"), (1, 2, "user", "> Thanks!\nYou are welcome."), (1, 3, "user", "> 今日は。\nGood day."), (1, 4, "user", "> Why?\nJust so."), (1, 5, "user", "> !!!\nWell.")]
    got = {r["turn"]: r for r in quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[t]["parent_turn"] for t in range(6)] == [None, None, 0, 1, None, None]
    assert [(got[t]["n_quoted"], got[t]["n_linked"]) for t in range(2, 6)] == [(1, 1), (1, 1), (1, 0), (0, 0)]


def test_quotes_empty(spark):
    assert quotes.link(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# -- 4: toxicity ------------------------------------------------------------------
def labelled(seed=1, n=400):
    """Documents with one of three insults (some disguised) where labelled toxic."""
    rng = random.Random(seed)
    v = vocabulary(rng)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        w = words(rng, rng.randint(20, 80), v).split(" ")
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["grumblebum", "Grumblebums", "nitwitted", "sl0bb3ring", "slobbering"]))
        docs.append((i, " ".join(w), "en"))
        labels.append((i, int(not toxic), int(toxic)))
    return docs, labels


def test_toxicity(spark):
    docs, labels = labelled()
    more = [(1001, "you gr\u0443mbl\u0435bum, n1tw1tted slobbering thing", "en"), (1002, None, "en"), (1003, "", "en"), (1004, "a slobbering dog " * 2, "en"), (None, "clean text", "en"), (5, docs[5][1], "en")]
    d, y = frame(spark, docs + more), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(d, y, exceptions=("slobbering dog",)).collect()
    assert len(got) == len(docs) + len(more)
    by = {r["doc_id"]: r for r in got}
    want = {i: t for i, _, t in labels}
    held = [i for i in want if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in want if by[i]["held_out"]} == set(held)
    assert sum(by[i]["predicted"] == want[i] for i in held) >= 0.97 * len(held)
    assert by[1001]["predicted"] == 1 and by[1002]["predicted"] == 0 and by[1003]["score"] == by[1002]["score"]
    assert by[1004]["n_matches"] == 0 and by[1004]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_held_out_labels_are_not_read(spark):
    docs, labels = labelled(2, 200)
    y = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    flipped = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, q, t) for i, q, t in labels]
    a = toxicity.score(frame(spark, docs), y(labels)).collect()
    b = toxicity.score(frame(spark, docs), y(flipped)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_folding():
    assert toxicity.fold("1D10T \u0456di\u043et 2020 $cum a$$ end$$$") == "idiot idiot 2020 scum a   end   "
    lex = toxicity.Lexicon({"scum": 2.0, "idiot ": 3.0}, {"pond scum"})
    assert [m[2] for m in lex.matches("pond scum! SCUMMY idiot idiotic unscum")] == [2.0, 3.0]
    assert toxicity.Lexicon({}, set()).features("any text") == [0.0, 0.0, 0.0]


def test_toxicity_without_labels(spark):
    docs, labels = labelled(3, 20)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(frame(spark, docs), none).collect()} == {0.0}
    assert toxicity.score(empty(spark), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_toxicity_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in Q.op4_toxicity(spark, SF).collect()}
    y = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert sum(got[r["doc_id"]]["predicted"] == r["toxic"] for r in y) >= 0.85 * len(y)


# -- 5: quality -------------------------------------------------------------------
def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in Q.op5_quality(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    y = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert sum(got[r["doc_id"]]["predicted"] == r["quality"] for r in y) >= 0.9 * len(y)
    assert sum(got[r["doc_id"]]["predicted"] for r in y if r["quality"] == 1) >= 0.95 * sum(r["quality"] for r in y)


def test_word_vectors_match_brute_force(spark):
    import numpy as np

    R = random_indexing
    docs = [(1, "a b c a b", "en"), (2, "c a", "en"), (3, "solo", "en"), (4, None, "en"), (5, "", "en")]
    table = np.zeros((R.BUCKETS, R.DIM))
    memo = R.Buckets()
    for _, t, _ in docs:
        w = R.buckets_of(t, memo)
        for i in range(len(w)):
            for j in range(max(0, i - R.WINDOW), min(len(w), i + R.WINDOW + 1)):
                if i != j:
                    for k in range(R.NONZERO):
                        table[w[i], R._DIMS[k][w[j]]] += R._SIGNS[k][w[j]]
    size = np.linalg.norm(table, axis=1, keepdims=True)
    used = size[:, 0] > 0
    table[used] /= size[used]
    table[used] -= table[used].mean(axis=0)
    assert np.allclose(R.word_vectors(frame(spark, docs)), table, atol=1e-5)


def test_network_learns_and_is_calibrated():
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(3))
    x = rng.normal(size=(1500, 10))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] * np.sign(x[:, 1]) + x[:, 2])))
    y = (rng.random(1500) < p).astype(float)
    net = random_indexing.Network(x[:1000], y[:1000])
    got = net.probability(x[1000:])
    assert np.mean((got > 0.5) == (p[1000:] > 0.5)) > 0.8
    for lo, hi in ((0.0, 0.3), (0.3, 0.7), (0.7, 1.0)):
        at = (got >= lo) & (got <= hi)
        assert abs(got[at].mean() - y[1000:][at].mean()) < 0.15


def test_quality_edge_cases(spark):
    docs, labels = labelled(4, 60)
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = random_indexing.score(frame(spark, [*docs, (None, None, None), (99, "", "en"), (3, docs[3][1], "en")]), y).collect()
    assert len(got) == 63 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in random_indexing.score(frame(spark, docs), none).collect()} == {0.5}
    assert random_indexing.score(empty(spark), y).count() == 0


# -- 6: urls ----------------------------------------------------------------------
URLS = [
    None, "", "no scheme", "://", "http://", "http://NET", "http://net/", "http://a.Net/x", "https://Example.NET/en/1", "https://example.net/en", "https://www.example.net/english/",
    "http://x.example.com/de/2?x=/y", "http://example.com/de?", "ftp://org/fr/#top", "http://a.org?x", "http://a.org#/fr/", "http://anet/", "http://a..net/", "http://a://b.net/", "a://B.C.ORG/fr/é?q",
]


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    for c in "#?":
        rest = rest.split(c, 1)[0]
    host, slash, path = rest.partition("/")
    host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + path
    best = None
    for verdict, h, p in Q.URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, *(best or (None, "allow"))


def test_urls_match_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", "clash") for i, u in enumerate(URLS)] + [(1, "http://net/", "x", "y")], "page_id long, url string, html string, host string")
    got = sorted(tuple(r) for r in url_filter.judge(pages, Q.URL_RULES).collect())
    assert got == sorted([(i, *brute_url(u)) for i, u in enumerate(URLS)] + [(1, *brute_url("http://net/"))])
    assert url_filter.judge(pages.limit(0), Q.URL_RULES).count() == 0


def test_trie_precedence():
    t = url_filter.RuleTrie([("block", "com", "/"), ("allow", "com", "/"), ("allow", "a.com", "/x/y"), ("block", "a.com", "/x/"), ("allow", "b.a.com", "/z/")])
    assert t.match("com", "/") == ("com/", "block")  # block before allow
    assert t.match("a.com", "/x/yes") == ("a.com/x/y", "allow")
    assert t.match("q.a.com", "/x/no") == ("a.com/x/", "block")
    assert t.match("b.a.com", "/x/y") == ("a.com/x/y", "allow")  # the deeper host has no fitting path
    assert t.match("acom", "/") is None and t.match("com", "") is None
    with pytest.raises(ValueError):
        url_filter.RuleTrie([("deny", "com", "/")])


def test_url_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(Q.ORACLE["op6_url_filter"]).fetchall()
    assert sorted(tuple(r) for r in Q.op6_url_filter(spark, SF).collect()) == sorted(want)
