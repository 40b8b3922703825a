"""Operator 8: base spans against regular expressions, the battery against scipy-free formulas, and redaction."""

import base64
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from panelcast.llm import secrets as S

from .fixtures import corpus, empty, frame

RULES = [
    ("assign", re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
]


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(RULES):
        for m in p.finditer(text or ""):
            size = len(m[1]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), k, kind, m.end()))
    return sorted(out)


def texts():
    rng = random.Random(3)
    token = lambda n: base64.b64encode(rng.randbytes(n)).decode().rstrip("=")
    return [
        'password: "hunter22"; SECRET=abcdef token token=token: abcdefg', "secret=token: abcdefgh", "token = a", "api-key=zzzzzz api_key='zzzzzzz'",
        "AKIA" + "A1" * 10 + "x AKIAABC XAKIA" + "B" * 17, "é𝄞 日 deadbeefdeadbeefdeadbeef00 deadbeef", "ABCDEFabcdef0123456789abcdef0",
        " ".join("0a1b2c3d4e5f60718293a4b5c6d7e8f9" for _ in range(700)), "passwd==abc.def PASSWORD  =  'abcdef",
        f"blob {token(60)} and this-is-not-a-secret-2020-07-15/path/to/file", f"key={token(45)}", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "http://a.example/2020/some-long-path-name/index1",
        "token='" + token(30) + "'",
    ]


@pytest.fixture(scope="module")
def rows():
    return corpus() + [(1000 + i, t, "en") for i, t in enumerate(texts())] + [(2000, texts()[0], "en"), (1000, texts()[0], "en")]


def spans_of(s):
    return [(int(a), int(b)) for _, a, b in (x.split(":") for x in s.split(","))] if s else []


def test_base_digest_matches_regular_expressions(spark, rows):
    got = S.report(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, t, _ in rows:
        b = base_spans(t)
        digest = ",".join(f"{k}:{s}:{e}" for s, _, k, e in b)
        want.append((i, *[sum(x[2] == kind for x in b) for kind, _ in RULES], hashlib.sha256(digest.encode()).hexdigest(), digest))
    key = lambda r: (str(r[0]), str(r[1:5]))
    for g, w in zip(sorted(got, key=lambda r: key(tuple(r))), sorted(want, key=key), strict=True):
        assert tuple(g)[:5] == w[:5]
        base_only = ",".join(x for x in g["spans"].split(",") if x and not x.startswith("random"))
        assert base_only == w[5]


def test_method_adds_random_tokens_and_leaves_paths(spark, rows):
    got = {r["doc_id"]: r["spans"] for r in S.report(frame(spark, rows)).collect()}
    assert "random:5:" in got[1009] and got[1009].count("random") == 1
    assert got[1012] == "" and got[1011] == "hex:0:29"
    assert "random" not in got[1013]  # inside a base span


def test_redaction(spark, rows):
    docs = frame(spark, rows)
    left = S.redact(docs)
    assert left.columns == docs.columns
    spans = {(r["doc_id"], r["base_sha256"]): spans_of(r["spans"]) for r in S.report(docs).collect()}
    by_id = {i: s for (i, _), s in spans.items()}
    want = []
    for i, t, _ in rows:
        out, at = "", 0
        if t is not None:
            for a, b in by_id[i]:
                if a >= at:
                    out += t[at:a] + "[secret]"
                at = max(at, b)
            out += t[at:]
        want.append((str(i), out if t is not None else None))
    got = [(str(r["doc_id"]), r["text"]) for r in left.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert left.filter(F.col("text").isNotNull() & (F.col("n_chars") != F.char_length("text"))).count() == 0


def brute_battery(token):
    for name, (pattern, alphabet) in S.ENCODINGS.items():
        if re.search(pattern, token):
            break
    body = token.rstrip("=")
    if name == "base64":
        body = body.replace("-", "+").replace("_", "/")
    n, a = len(body), len(alphabet)
    chi = a / n * sum(body.count(c) ** 2 for c in set(body)) - n
    df = a - 1
    z = ((max(chi, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    p1 = max(0.5 * math.erfc(z / math.sqrt(2)), 5e-10)
    bits = [alphabet.index(c) >= a // 2 for c in body]
    ones = sum(bits)
    runs = 1 + sum(x != y for x, y in zip(bits, bits[1:]))
    mu = 1 + 2 * ones * (n - ones) / n
    var = (mu - 1) * (mu - 2) / (n - 1)
    p2 = max(math.erfc(abs(runs - mu) / math.sqrt(var) / math.sqrt(2)), 1e-9) if var > 0 else 1e-9
    v = [alphabet.index(c) + 1 for c in body]
    m = sum(v) / n
    ss = sum((x - m) ** 2 for x in v)
    r = sum((x - m) * (y - m) for x, y in zip(v, v[1:])) / ss if ss else 0
    p3 = max(math.erfc(abs((r + 1 / n) * math.sqrt(n)) / math.sqrt(2)), 1e-9) if ss else 1e-9
    h = -sum(map(math.log, (p1, p2, p3)))
    return name, n, p1, p2, p3, math.exp(-h) * (1 + h + h * h / 2)


def test_battery_matches_formulas(spark):
    rng = random.Random(8)
    tokens = ["".join(rng.choice("0123456789abcdef") for _ in range(20)) + "a1" for _ in range(10)]
    tokens += [base64.b64encode(rng.randbytes(n)).decode() for n in (16, 31, 64, 200)] + [base64.b32encode(rng.randbytes(25)).decode() + "A2"]
    tokens += ["this-is-not-a-secret-2020-07-15", "abcdefghijklmnopqrst1", "a" * 30 + "1", "A_b-C+d/E0f1G2h3I4j5K6"]
    d = S.battery(spark.createDataFrame([(t,) for t in tokens], "token string"))
    for r in d.collect():
        w = brute_battery(r["token"])
        assert (r["encoding"], r["n"]) == w[:2]
        assert [r["p_uniform"], r["p_runs"], r["p_serial"], r["p"]] == pytest.approx(list(w[2:]), rel=2e-2, abs=2e-6), r["token"]


def test_false_discovery_control(spark):
    # by band: 50 structured tokens (p tiny) and 50 random ones
    rows = [("hex", 32, -100 - i) for i in range(50)] + [("hex", 32, -i % 30) for i in range(50)] + [("hex", 64, -5)]
    t = spark.createDataFrame([(e, b, min(0, -abs(s))) for e, b, s in rows], "encoding string, band int, step int")
    cuts = {(r["encoding"], r["band"]): r["cut"] for r in S.thresholds(t).collect()}
    p = sorted(10 ** (min(0, -abs(s)) / S.STEPS) for e, b, s in rows if b == 32)
    k = max(i + 1 for i, x in enumerate(p) if x <= S.FDR * (i + 1) / len(p))
    assert 10 ** (cuts["hex", 32] / S.STEPS) == pytest.approx(p[k - 1])
    assert cuts["hex", 64] == -1_000_000


WORDS = (
    "summary page draft client update order record invoice payment report account service customer region window panel series "
    "daily weekly forecast history version release project folder section chapter header footer button image upload download "
    "search filter result index table column value number total average balance transfer request response handler manager"
).split()


def identifiers(n, seed):
    """Names and paths of 20 and more characters in several styles, all different."""
    rng, out = random.Random(seed), set()
    while len(out) < n:
        w = [rng.choice(WORDS) for _ in range(rng.randint(3, 6))]
        name = rng.choice(
            ["-".join(w) + f"-v{rng.randint(1, 30)}", w[0] + "".join(x.title() for x in w[1:]) + str(rng.randint(1, 4000)), "_".join(w) + f"_{rng.randint(1990, 2030)}",
             "/".join(w) + f"/{rng.randint(1, 99)}", "-".join(w) + f"-2020-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", "_".join(w).upper() + f"_{rng.randint(1, 99)}"]
        )
        if len(name) >= 20:
            out.add(name)
    return sorted(out)


def secrets(n, seed):
    rng = random.Random(seed)
    letters = S.UPPER + S.LOWER + S.DIGITS
    out = []
    while len(out) < n:
        kind, size = rng.randrange(4), rng.randint(24, 64)
        alphabet = [letters, letters + "-_", S.DIGITS + S.LOWER, S.UPPER + "234567"][kind]
        t = "".join(rng.choice(alphabet) for _ in range(size))
        if re.fullmatch(S.CANDIDATE, t) and not re.search("[0-9a-f]{24}|AKIA", t):
            out.append(t)
    return out


def test_ordinary_names_alone_are_no_secrets(spark):
    names = identifiers(1500, 1)
    docs = frame(spark, [(i, t, "en") for i, t in enumerate(names)])
    flagged = [r["doc_id"] for r in S.report(docs).collect() if "random" in r["spans"]]
    assert len(flagged) <= 0.05 * len(names), [names[i] for i in flagged[:9]]


def test_planted_secrets_are_found_among_names_and_prose(spark):
    rng = random.Random(5)
    names, planted = identifiers(600, 2), secrets(200, 3)
    prose = lambda: " ".join(rng.choice(WORDS) for _ in range(30))
    rows = [(i, f"{prose()} {t} {prose()}", "en") for i, t in enumerate(names + planted)]
    got = {r["doc_id"]: r["spans"] for r in S.report(frame(spark, rows)).collect()}
    hit = {i for i, s in got.items() if "random" in s}
    right = sum(i >= len(names) for i in hit)
    assert right >= 0.9 * len(planted), right
    assert len(hit) - right <= 0.05 * len(hit), [rows[i][1] for i in sorted(hit)[:5]]
    # the span is the token
    at = {i: t for i, (_, t, _) in enumerate(rows)}
    for i in sorted(hit)[-20:]:
        (a, b), token = spans_of(got[i])[0], planted[i - len(names)]
        assert at[i][a:b] == token


def test_model_of_words_matches_counting(spark):
    texts = ["The quick-brown fox2 jumps, über 42 fences", "the THE lazy_dog 7", None, "", "x", "z" * 41]
    bits, mean, spread = S.ordinary(frame(spark, [(i, t, "en") for i, t in enumerate(texts)]))
    words = {w for t in texts if t for w in re.findall("[a-z]+|[0-9]+", t.lower()) if 40 >= len(w) > w.isalpha()}
    size, pairs = len(S.SIGNS), []
    for w in words:
        f = "-" + re.sub("[0-9]", "0", w) + "-"
        pairs.append([S.SIGNS.index(x) * size + S.SIGNS.index(y) for x, y in zip(f, f[1:])])
    flat = [p for x in pairs for p in x]
    row = lambda p: sum(q // size == p // size for q in flat)
    want = [-math.log2((flat.count(p) + 1) / (row(p) + size)) for p in range(size * size)]
    assert bits == pytest.approx(want)
    assert mean == pytest.approx(sum(want[p] for p in flat) / len(flat))
    assert spread == pytest.approx(math.sqrt(sum((sum(want[p] for p in x) - len(x) * mean) ** 2 for x in pairs) / len(flat)))
    token = "AbC-9z" * 4
    f = "-" + re.sub("[^a-z0]", "-", re.sub("[0-9]", "0", token.lower())) + "-"
    own = [want[S.SIGNS.index(x) * size + S.SIGNS.index(y)] for x, y in zip(f, f[1:])]
    z = (sum(own) - len(own) * mean) / (spread * math.sqrt(len(own)))
    got = S.beyond_words(spark.createDataFrame([(token,)], "token string"), (bits, mean, spread)).first()["p_words"]
    assert got == pytest.approx(max(0.5 * math.erfc(z / math.sqrt(2)), 5e-10), rel=1e-3, abs=1e-7)


def test_empty_table(spark):
    assert S.report(empty(spark)).count() == 0 and S.redact(empty(spark)).count() == 0
