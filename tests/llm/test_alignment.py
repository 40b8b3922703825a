"""Operator 12 against loops over both tokenizers' tokens."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelcast.llm import alignment as A

from .fixtures import corpus, empty, frame


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A.A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=A.B_FILE)


def tokens(text, tokenizers):
    """((id, bytes), ...) of both sides, or none."""
    if not text:
        return [], []
    a, b = tokenizers
    alphabet = A.byte_alphabet()
    left = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])


def ranges(side):
    at, out = 0, []
    for i, x in side:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def links(left, right):
    """Pairs of overlapping tokens, by a merge over both sides."""
    out, j = [], 0
    for i, s, e in left:
        while right[j][2] <= s:
            j += 1
        k = j
        while k < len(right) and right[k][1] < e:
            out.append((i, right[k][0]))
            k += 1
    return out


def brute(rows, tokenizers):
    sides = [tuple(map(ranges, tokens(t, tokenizers))) for _, t, _ in rows]
    linked = [links(a, b) if a else [] for a, b in sides]
    count = Counter(p for x in linked for p in x)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (i, _, _), (a, b), x in zip(rows, sides, linked, strict=True):
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        text, start = [], 0
        for end in ends:
            parts = (",".join(str(t) for t, s, e in side if start <= s and e <= end) for side in (a, b))
            text.append("|".join(parts))
            start = end
        digest = hashlib.sha256(";".join(text).encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(ends), len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), digest))
    return out


AWKWARD = [
    (200, "<|endoftext|> and <s> </s> <unk> <0x0A> in a text", "en"), (201, "\U0001f600\U0001f9d1‍\U0001f680 emoji", "en"),
    (202, "▁ a blank that B writes itself", "en"), (203, "   leading  and trailing   ", "en"), (204, "tab\tline\r\nnul\x00 end", "en"),
    (205, " ", "en"), (206, "\n", "en"), (207, "naïve café — “quoted” … ½ ﬁ", "fr"), (208, "a" * 3000, "en"), (209, "한국어 العربية ไทย", "ko"),
]


def rows():
    return [r for r in corpus(9, 25) if r[0] != 106] + AWKWARD  # the longest is tested apart: the loops are slow


def test_matches_brute_force(spark, tokenizers):
    got = A.report(frame(spark, rows()).repartition(4))
    want = brute(rows(), tokenizers)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > len(AWKWARD)
    assert next(r for r in want if r[0] == 202)[1:] == (0, 0, 0, 0, 0, 0, "")


def test_many_shards_and_blocks(spark, tokenizers):
    got = A.report(frame(spark, rows()).repartition(6), shard_pairs=20, block_pairs=150)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows(), tokenizers), key=str)


def test_tables_without_tokens(spark):
    assert A.report(empty(spark)).count() == 0
    got = A.report(frame(spark, [(1, None, "en"), (2, "", "en"), (2, "", "en")])).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 2)]


def test_the_quicker_tokenizer_gives_the_same_ids(tokenizers):
    import random

    rng = random.Random(5)
    signs = "abc XYZ 'll's 12½²³ éÈßŁſ\t\n\r .,;!?#&<>|ªº\u00a1ƿǅ\u024f"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 80))) for _ in range(2000)] + ["x" * 5000, " " * 300, "a " * 500]
    encode, table = A.tokenizer_a(A.A_FILE)
    assert not any(A._OTHER.search(t) for t in texts)
    assert encode(texts) == [e.ids for e in tokenizers[0].encode_batch(texts, add_special_tokens=False)]
    assert [b"".join(table[i] for i in ids) for ids in encode(texts)] == [t.encode() for t in texts]


def test_long_texts_are_cut_where_tokens_end():
    text = next(t for i, t, _ in corpus(9, 25) if i == 106) + "  two  blanks \n new\tline  é ▁ x" + " y" * 50
    text = text.replace("▁", "_")
    whole = next(A.Coder(A.A_FILE, A.B_FILE).encode([text]))
    parts = next(A.Coder(A.A_FILE, A.B_FILE, limit=40).encode([text]))
    assert parts == whole and len(whole[0]) > 1000
    encode_a, encode_b = A.tokenizer_a(A.A_FILE)[0], A.tokenizer_b(A.B_FILE)[0]
    assert whole == tuple(np.array(e([t])[0], "<u2").tobytes() for e, t in ((encode_a, " " + text), (encode_b, text)))


def test_words_give_the_library_s_ids():
    own, encode = A.Coder(A.A_FILE, A.B_FILE), A.tokenizer_b(A.B_FILE)[0]
    assert own.by_words
    texts = [t for _, t, _ in [*corpus(4, 40), *AWKWARD] if t]
    for t, (_, body) in zip(texts, own.encode(texts), strict=True):
        assert body == (b"" if "▁" in t else np.array(encode([t])[0], "<u2").tobytes())
    assert own.words


def test_cuts():
    text = next(t for i, t, _ in corpus(9, 25) if i == 106)
    assert len(A.cut(text, 40)) > 100 and "".join(A.cut(text, 40)) == text


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
    mph = A.PerfectHash.read(*A.PerfectHash.build(keys).dump())
    assert sorted(mph.index(keys).tolist()) == list(range(len(keys)))
    others = mph.index(rng.integers(-(1 << 62), 1 << 62, 100))
    assert ((others >= -1) & (others < max(len(keys), 1))).all()


def test_unknown_pairs_are_not_found(spark):
    from types import SimpleNamespace

    keys = np.array([5 << 32 | 1, 5 << 32 | 2, 9 << 32 | 1])
    mph = A.PerfectHash.build(keys)
    ordered = np.empty_like(keys)
    ordered[mph.index(keys)] = keys
    sizes, packed = mph.dump()
    block = A.Block([SimpleNamespace(shard=0, size=3, sizes=sizes, packed=packed, pairs=ordered.tobytes())], A.PARTS)
    asked = np.concatenate([keys, np.arange(1000) + (7 << 32)])
    found = block.index(asked)
    assert sorted(found[:3].tolist()) == [0, 1, 2] and (found[3:] == -1).all()


def test_tree_sum(spark):
    vectors = np.random.default_rng(1).integers(0, 9, (70, A.CHUNK + 10))
    data = [(t, c, v[c * A.CHUNK : (c + 1) * A.CHUNK].tobytes()) for t, v in enumerate(vectors) for c in (0, 1)]
    df = spark.createDataFrame(data, "team long, chunk long, vector binary")
    assert (A.tree_sum(df, len(vectors)) == vectors.sum(0)).all()
