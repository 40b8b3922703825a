"""Small documents with every awkward case, and an extra column whose name operators use themselves."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, th string, label string"


def words(rng: random.Random, n: int, vocabulary: list[str]) -> str:
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def vocabulary(rng: random.Random, n: int = 400) -> list[str]:
    syllables = "an the er on re ti en es or st nd ha ing ou at ly".split()
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus(seed: int = 1, n: int = 40) -> list[tuple]:
    """(doc_id, text, lang) rows: random texts, exact and near copies, nulls, empty, blank, very long, repeated rows."""
    rng = random.Random(seed)
    v = vocabulary(rng)
    rows = [(i, words(rng, rng.randint(12, 120), v), rng.choice(["en", "fr", None])) for i in range(n)]
    rows += [(n + i, rows[i][1], rows[i][2]) for i in range(5)]  # exact copies
    for i in range(5, 15):  # near copies: one or several words changed
        w = rows[i][1].split(" ")
        for _ in range(1 + i % 3):
            w[rng.randrange(len(w))] = "changed"
        rows.append((n + i, " ".join(w), rows[i][2]))
    rows += [
        (100, None, "en"), (101, "", "en"), (102, " \n\t ", None), (103, "one", "en"), (104, "One two  three\nfour", "en"),
        (105, "one two three four", "fr"), (106, words(rng, 30_000, v), "en"), (107, "x" * 50_000, "en"),
        (None, words(rng, 40, v), "en"), (None, None, None), (3, rows[3][1], rows[3][2]),
        (108, "日本語 テキスト 𝄞 é ÉCOLE École\n日本語 テキスト 𝄞", "ja"),
    ]
    return rows


def frame(spark, rows: list[tuple]):
    full = [(i, t, g, "src", None if t is None else len(t), 0.5, "x", "y", "z") for i, t, g in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
