"""Secret scans with a randomness test battery (operator 8), in DataFrame functions only.

Base rules give the kinds assign, access and hex. The method adds the kind random: a run of 20 or more characters of the
base64 alphabets with a letter and a digit is a candidate; its encoding is inferred as the smallest alphabet that holds it
(hex, upper-case hex, base32, base36, base64 in either form). Three tests take "drawn evenly from that alphabet" as their
null hypothesis:

* chi-squared for even use of the alphabet (Wilson-Hilferty normal form),
* runs of low and high symbols (Wald-Wolfowitz),
* serial correlation of successive symbols at lag one.

Fisher's method combines their p-values (six degrees of freedom, a closed form). Within each encoding and length band a
Benjamini-Hochberg procedure at ``FDR`` rejects the structured candidates, so that many short tokens don't settle the
threshold of long ones. That alone controls how many secrets are lost. How many ordinary names are called secrets is
controlled by the opposite null hypothesis, "made of ordinary words": the corpus' distinct words and numbers give a
character-bigram model (letters without case, digits as one sign, everything else as a word's end) and the spread of a
word's surprisal under it; a candidate's surprisal, normal in this null with variance in proportion to its length, gives a
p-value, and within each length band Benjamini-Hochberg at ``FDR`` selects the candidates that are more random than words
are. A secret is selected there and not rejected by the battery. Both procedures work on the counts of
rounded p-values per band (a bounded table), never on a sorted list of all candidates.

Spans are code points, end exclusive. A random span that overlaps a base span of its text is left out. All work after one
scan is on the distinct texts (by hash) that hold a match.

Cases: null text counts as empty and has no spans; repeated rows get equal results; long texts are scanned whole; an empty
table gives an empty result; other columns are not read (``redact`` keeps them, with text and n_chars changed).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_ASSIGN = 6
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Any text with a span or a candidate matches this.
ANY = rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|{ACCESS}|{HEX}|{CANDIDATE}"""

KINDS = ("assign", "access", "hex", "random")
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: name -> (pattern of the whole token, alphabet in its encoding's order); the first that matches is inferred.
ENCODINGS = {
    "hex": ("^[0-9a-f]+$", DIGITS + LOWER[:6]),
    "HEX": ("^[0-9A-F]+$", DIGITS + UPPER[:6]),
    "base32": ("^[A-Z2-7]+=*$", UPPER + "234567"),
    "base36": ("^[0-9a-z]+$", DIGITS + LOWER),
    "base64url": ("^[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
    "base64": ("^[A-Za-z0-9+/_-]+=*$", UPPER + LOWER + DIGITS + "+/"),
}
#: Length bands: the last bound that a length reaches.
BANDS = (20, 32, 48, 64, 128, 256)
FDR = 0.05
#: p-values are rounded up to powers of ten in steps of 1 / STEPS.
STEPS = 20
BLOCK = 256


def _prefix_sums(df: DataFrame, lengths: str, out: str) -> DataFrame:
    """Column ``out``: for each element of ``lengths`` the sum of those before it; in blocks, so that many matches in one
    text stay far from quadratic. Arrays that a lambda reads are named twice, which keeps Catalyst from computing them
    again for each element."""
    zero = F.lit(0).cast("long")
    add = lambda a, x: a + x
    n, x = F.size(lengths), F.col(lengths)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda c: F.aggregate(F.slice(x, c * BLOCK + 1, BLOCK), zero, add))
    df = df.withColumn("__blocks", F.when(n > 0, blocks).otherwise(F.array().cast("array<bigint>")))
    b = F.col("__blocks")
    before = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.aggregate(F.slice(b, 1, F.floor(i / BLOCK).cast("int")), zero, add)
        + F.aggregate(F.slice(x, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK), zero, add),
    )
    return df.withColumn(out, F.when((n > 0) & (F.size(b) > 0), before).otherwise(F.array().cast("array<bigint>"))).drop("__blocks")


def _matches(texts: DataFrame, kind: str, pattern: str) -> DataFrame:
    """(th, kind, start, end, token): every leftmost, non-overlapping match. Between n matches stand n + 1 gaps, whose
    lengths with those of the matches add up to the places."""
    d = texts.filter(F.col("text").rlike(pattern))
    d = d.withColumn("__m", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    d = d.withColumn("__v", F.regexp_extract_all("text", F.lit(pattern), F.lit(1)) if kind == "assign" else F.col("__m"))
    d = d.withColumn("__gap", F.transform(F.split("text", pattern, -1), lambda g: F.char_length(g).cast("long"))).drop("text")
    d = d.withColumn("__step", F.zip_with(F.slice("__gap", 1, F.size("__m")), "__m", lambda g, m: g + F.char_length(m)))
    d = _prefix_sums(d, "__step", "__before")
    d = d.select("th", F.explode(F.arrays_zip("__before", "__gap", "__m", "__v")).alias("x")).filter(F.col("x.__m").isNotNull())
    start = F.col("x.__before") + F.col("x.__gap")
    d = d.select("th", F.lit(kind).alias("kind"), start.alias("start"), (start + F.char_length("x.__m")).alias("end"), F.col("x.__m").alias("token"), F.col("x.__v").alias("value"))
    if kind == "assign":
        d = d.filter(F.char_length("value") >= MIN_ASSIGN)
    return d.drop("value")


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|) by the Abramowitz-Stegun rational form 26.2.17 (absolute error under 1e-7, so p is kept above 1e-9)."""
    x = F.least(F.abs(z), F.lit(8.0))
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.greatest(2 * poly * F.exp(-x * x / 2) / math.sqrt(2 * math.pi), F.lit(1e-9))


def normal_upper(z: Column) -> Column:
    half = normal_two_sided(z) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def battery(candidates: DataFrame) -> DataFrame:
    """Adds encoding, n, band, the three p-values and Fisher's combination p to rows with a ``token``."""
    enc = F.coalesce(*[F.when(F.col("token").rlike(p), F.lit(name)) for name, (p, _) in ENCODINGS.items()])
    d = candidates.withColumn("encoding", enc).filter(F.col("encoding").isNotNull())
    pick = lambda f: F.coalesce(*[F.when(F.col("encoding") == name, f(a)) for name, (_, a) in ENCODINGS.items()])
    low = lambda a: F.translate("__body", a, "0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2))
    # base64 in the form with + and / reads the other form's signs as its own
    body = F.translate(F.regexp_replace("token", "=+$", ""), "-_", "+/")
    d = d.withColumn("__body", F.when(F.col("encoding") == "base64", body).otherwise(F.regexp_replace("token", "=+$", "")))
    d = d.withColumn("n", F.char_length("__body")).withColumn("__chars", F.split("__body", ""))
    d = d.withColumn("__chars", F.filter("__chars", lambda c: c != ""))
    d = d.withColumn("__kinds", F.array_distinct("__chars")).withColumn("__size", pick(lambda a: F.lit(len(a))).cast("double"))
    squares = F.aggregate("__kinds", F.lit(0.0), lambda s, c: s + F.pow(F.col("n") - F.char_length(F.replace(F.col("__body"), c, F.lit(""))), F.lit(2)))
    n, a = F.col("n").cast("double"), F.col("__size")
    d = d.withColumn("__chi", a / n * squares - n)
    df = a - 1
    d = d.withColumn("p_uniform", normal_upper((F.pow(F.greatest(F.col("__chi"), F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))))
    d = d.withColumn("__bits", pick(low))
    d = d.withColumn("__ones", F.char_length(F.replace(F.col("__bits"), F.lit("0"), F.lit(""))).cast("double"))
    d = d.withColumn("__runs", F.char_length(F.regexp_replace("__bits", "(0+|1+)", "x")).cast("double"))
    mu = 1 + 2 * F.col("__ones") * (n - F.col("__ones")) / n
    d = d.withColumn("__mu", mu).withColumn("__var", (F.col("__mu") - 1) * (F.col("__mu") - 2) / (n - 1))
    d = d.withColumn("p_runs", F.when(F.col("__var") > 0, normal_two_sided((F.col("__runs") - F.col("__mu")) / F.sqrt("__var"))).otherwise(F.lit(1e-9)))
    d = d.withColumn("__at", _places())
    sums = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    v = F.col("__at")
    d = d.withColumn("__mean", sums(v) / n)
    d = d.withColumn("__dev", F.transform("__at", lambda x: x - F.col("__mean"))).drop("__at")
    dev = F.col("__dev")
    lag = F.zip_with(F.slice(dev, 1, F.col("n") - 1), F.slice(dev, 2, F.col("n") - 1), lambda x, y: x * y)
    d = d.withColumn("__lag", sums(lag)).withColumn("__ss", sums(F.transform("__dev", lambda x: x * x)))
    # under the null the coefficient has mean -1/n and variance about 1/n
    r = F.col("__lag") / F.col("__ss")
    d = d.withColumn("p_serial", F.when(F.col("__ss") > 0, normal_two_sided((r + 1 / n) * F.sqrt(n))).otherwise(F.lit(1e-9)))
    half = -(F.log("p_uniform") + F.log("p_runs") + F.log("p_serial"))
    d = d.withColumn("__half", half).withColumn("p", F.exp(-F.col("__half")) * (1 + F.col("__half") + F.col("__half") * F.col("__half") / 2))
    band = F.greatest(*[F.when(F.col("n") >= b, F.lit(b)).otherwise(F.lit(0)) for b in BANDS])
    return d.withColumn("band", band).drop(*[c for c in d.columns if c.startswith("__")])


def _places() -> Column:
    """Each character's place in the alphabet of the row's encoding."""
    alphabet = F.coalesce(*[F.when(F.col("encoding") == name, F.lit(a)) for name, (_, a) in ENCODINGS.items()])
    return F.transform("__chars", lambda c: F.position(c, alphabet).cast("double"))


#: Signs of the model of ordinary words: letters, a digit, a word's end.
SIGNS = LOWER + "0-"
#: A word or a number of a lower-cased text; longer runs are no words.
ORDINARY = "(?<![a-z])[a-z]{2,40}(?![a-z])|(?<![0-9])[0-9]{1,40}(?![0-9])"


def folded(text: Column) -> Column:
    """Text in ``SIGNS``, with an end on either side."""
    return F.concat(F.lit("-"), F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), "[^a-z0]", "-"), F.lit("-"))


def _pairs(text: str) -> Column:
    """Each pair of neighbouring signs of a column as 28 * first + second."""
    place = lambda i: F.position(F.substring(F.col(text), i, F.lit(1)), F.lit(SIGNS)) - 1
    return F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: place(i) * len(SIGNS) + place(i + 1))


def ordinary(docs: DataFrame) -> tuple[list[float], float, float]:
    """(surprisal in bits of each pair of signs, a pair's mean, a pair's standard deviation within words) over the distinct words
    and numbers of all texts: a word counts once, however often it is copied."""
    found = F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(ORDINARY), F.lit(0))))
    words = docs.select(found.alias("w")).distinct().select(folded(F.col("w")).alias("w"))
    words = written(words.select(_pairs("w").alias("pairs")), "words")
    size = len(SIGNS)
    counts = [[0] * size for _ in range(size)]
    for pair, c in words.select(F.explode("pairs").alias("pair")).groupBy("pair").count().collect():  # size * size rows at most
        counts[pair // size][pair % size] = c
    bits = [-math.log2((c + 1) / (sum(row) + size)) for row in counts for c in row]
    total = sum(map(sum, counts))
    if not total:
        return bits, math.log2(size), 1.0
    mean = sum(c * b for c, b in zip([c for row in counts for c in row], bits, strict=True)) / total
    off = _surprisal("pairs", bits) - F.size("pairs") * mean
    return bits, mean, math.sqrt((words.agg(F.sum(off * off)).first()[0] or 0.0) / total) or 1.0


def _surprisal(pairs: str, bits: list[float]) -> Column:
    table = F.array(*[F.lit(b) for b in bits])
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + F.get(table, x))


def beyond_words(candidates: DataFrame, model: tuple[list[float], float, float]) -> DataFrame:
    """Adds ``p_words``: how likely a text made of ordinary words has the token's surprisal or more."""
    bits, mean, spread = model
    d = candidates.withColumn("__fold", folded(F.col("token"))).withColumn("__pairs", _pairs("__fold"))
    n = F.size("__pairs").cast("double")
    z = (_surprisal("__pairs", bits) - n * mean) / (spread * F.sqrt(n))
    return d.withColumn("p_words", normal_upper(z)).drop("__fold", "__pairs")


def _step(p: str) -> Column:
    return F.ceil(F.log10(F.greatest(p, F.lit(1e-300))) * STEPS).cast("int")


def thresholds(tested: DataFrame) -> DataFrame:
    """(encoding, band, cut): candidates whose rounded log p is at most ``cut`` are rejected as structured. A row per
    encoding and band at most."""
    counts = tested.groupBy("encoding", "band", "step").agg(F.count("*").alias("c"))
    group = W.partitionBy("encoding", "band")
    c = counts.withColumn("k", F.sum("c").over(group.orderBy("step"))).withColumn("m", F.sum("c").over(group))
    ok = F.pow(F.lit(10.0), F.col("step") / STEPS) <= FDR * F.col("k") / F.col("m")
    return c.groupBy("encoding", "band").agg(F.coalesce(F.max(F.when(ok, F.col("step"))), F.lit(-1_000_000)).alias("cut"))


def spans(docs: DataFrame) -> DataFrame:
    """(th, kind, start, end) of every span in the distinct texts, by the text's hash."""
    texts = docs.select("text").filter(F.col("text").rlike(ANY)).withColumn("th", F.xxhash64("text")).dropDuplicates(["th"])
    texts = written(texts, "texts-with-matches")
    base = None
    for kind, pattern in zip(KINDS, (ASSIGN, ACCESS, HEX), strict=False):
        m = _matches(texts, kind, pattern).drop("token")
        base = m if base is None else base.unionByName(m)
    base = written(base, "base-spans")
    tested = beyond_words(battery(_matches(texts, "random", CANDIDATE)), ordinary(docs))
    tested = tested.withColumn("step", _step("p")).withColumn("words", _step("p_words"))
    tested = written(tested.select("th", "kind", "start", "end", "encoding", "band", "step", "words"), "candidates")
    cuts = F.broadcast(thresholds(tested))  # at most a row per encoding and band
    more = thresholds(tested.select(F.lit("any").alias("encoding"), "band", F.col("words").alias("step")))
    more = F.broadcast(more.select("band", F.col("cut").alias("most")))  # at most a row per band
    random = tested.join(cuts, ["encoding", "band"]).join(more, "band").filter("step > cut AND words <= most").select("th", "kind", "start", "end")
    b = base.select(F.col("th").alias("bt"), F.col("start").alias("bs"), F.col("end").alias("be"))
    apart = random.join(b, (F.col("th") == F.col("bt")) & (F.col("start") < F.col("be")) & (F.col("bs") < F.col("end")), "left_anti")
    return base.unionByName(apart)


def _by_text(docs: DataFrame) -> DataFrame:
    """(th, s): the spans of each text, ordered by start, then kind as listed."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    one = F.struct("start", rank.alias("rank"), "kind", "end")
    return spans(docs).groupBy("th").agg(F.sort_array(F.collect_list(one)).alias("s"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    d = docs.select("doc_id", F.xxhash64("text").alias("th")).join(_by_text(docs), "th", "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    d = d.select("doc_id", F.coalesce("s", none).alias("s"))
    count = lambda k: F.size(F.filter("s", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("s", lambda x: x["kind"] != "random")
    return d.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("s")).alias("spans"), count("random"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by ``mark`` (overlapping spans by one) and n_chars counted anew."""
    hot = _by_text(docs.select("text")).select(F.col("th").alias("__llm_th"), F.col("s").alias("__llm_s"))
    d = docs.withColumn("__llm_key", F.xxhash64("text")).join(hot, F.col("__llm_key") == F.col("__llm_th"), "left")
    # fold the sorted spans: copy what stands before each, skip what it covers
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        new = F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], F.array(gap, F.lit(mark))).alias("out"))
        return F.when(x["start"] >= acc["at"], new).otherwise(F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out")))

    end = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    clean = F.when(F.col("__llm_s").isNull(), F.col("text")).otherwise(F.aggregate("__llm_s", start, step, end))
    d = d.withColumn("__llm_text", clean)
    new = {"text": F.col("__llm_text"), "n_chars": F.when(F.col("__llm_s").isNull(), F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).otherwise(F.char_length("__llm_text").cast("long"))}
    return d.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
