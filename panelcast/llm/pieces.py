"""A SentencePiece vocabulary read as a unigram lattice, shared by the encoder (operator 1) and the counter (operator 7).

The model file (a parameter; never copied) gives pieces and scores; the score of a segmentation is the sum of its pieces'
scores. A blank is written as U+2581, one is put before a text. A character that no single-character piece covers is an
unknown of the least score minus 10, and is written as its UTF-8 bytes' pieces where the vocabulary has them.

Ties follow the tokenizer's own rule: of equally good ways to reach a place, the one whose last piece starts first wins.
Scores are summed exactly (the library sums in 32-bit floats, so a very long text may tie differently there).

Blanks occur only at the front of pieces, so no piece crosses from another character to a blank; nor does one cross a place
between two characters that stand side by side in no piece. There a text's lattice falls apart: chunks (blanks and what
follows them) and, within a chunk, parts are solved by themselves, and those that occur again are looked up in a bounded
memory.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import ahocorasick
import sentencepiece

BLANK = "▁"
CHUNK = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
UNKNOWN_PENALTY = 10.0
#: Chunks and parts of at most MEMO_CHARS characters are kept, 2 * MEMO of them at most (some 200 MB in a Python worker).
MEMO, MEMO_CHARS = 300_000, 48


class Vocabulary(NamedTuple):
    pieces: dict[str, tuple[int, float]]
    text: list[str]  # by id
    byte_ids: list[int]  # by byte; empty without byte fallback
    unknown_id: int
    unknown_score: float
    longest: int


def load(path: str) -> Vocabulary:
    """Read a model file; raises where a piece has a blank after another character (chunks would not be independent)."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    text = [sp.id_to_piece(i) for i in range(n)]
    normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
    pieces = {text[i]: (i, sp.get_score(i)) for i in normal}
    if any(not re.fullmatch(f"{BLANK}*[^{BLANK}]*", p) for p in pieces):
        raise ValueError("a piece has a blank after another character")
    by_byte = {int(text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
    byte_ids = [by_byte[b] for b in range(256)] if len(by_byte) == 256 else []
    least = min(s for _, s in pieces.values())
    return Vocabulary(pieces, text, byte_ids, sp.unk_id(), least - UNKNOWN_PENALTY, max(map(len, pieces)))


def piece_automaton(v: Vocabulary) -> ahocorasick.Automaton:
    """Gives at each end place the (length, id, score) of the pieces that end there, longest first."""
    a = ahocorasick.Automaton()
    for piece, (i, score) in v.pieces.items():
        a.add_word(piece, (len(piece), i, score))
    a.make_automaton()
    return a


def chunks(text: str) -> list[str]:
    """The independent parts of a non-empty text's lattice."""
    return CHUNK.findall(BLANK + text.replace(" ", BLANK))


def unknown_ids(v: Vocabulary, char: str) -> tuple[int, ...]:
    if not v.byte_ids:
        return (v.unknown_id,)
    return tuple(v.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))


def neighbours(v: Vocabulary) -> frozenset[str]:
    """The pairs of characters that stand side by side in some piece."""
    return frozenset(p[i : i + 2] for p in v.pieces for i in range(len(p) - 1))


def parts(chunk: str, pairs: frozenset[str]) -> list[str]:
    """The independent parts of a chunk (a word of letters alone is taken as one)."""
    if chunk[1:].isalpha():
        return [chunk]
    cuts = [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in pairs]
    return [chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True)] if cuts else [chunk]


class Memo(dict):
    """Results by chunk in two generations: a full young one becomes the old one, a hit in the old one moves up."""

    def __init__(self, compute, size: int | None = None):
        super().__init__()
        self.compute, self.old, self.size = compute, {}, size

    def __missing__(self, chunk: str):
        got = self.old.get(chunk)
        if got is None:
            got = self.compute(chunk)
            if len(chunk) > MEMO_CHARS:
                return got
        if len(self) >= (self.size or MEMO):
            self.old = dict(self)
            self.clear()
        self[chunk] = got
        return got
