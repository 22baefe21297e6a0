"""Count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates all vocabulary pieces in a text; dynamic
programming over the positions carries the best score and how many pieces it took,
nothing else.  Rules are those of the usual unigram tokenizers: scores add up in
double precision; for equal scores the piece that starts first (the longest) stays;
a position where no piece of one character starts may step over that character
at ten below the least score; such characters fall back to their bytes, one piece each.

A blank is the word mark of the vocabulary and one is put in front of a text that is
not empty.  No piece holds a mark after another character, nor a control
character that the vocabulary lacks, so every segmentation breaks there and the
parts between are solved on their own, each distinct one once per worker.
Scores of the vocabulary file are whole numbers, so sums of parts are exact.

Defined results: null and empty texts have no token and score 0; a text without
any known character is its bytes; long texts are taken whole, in time
proportional to their length; equal texts have equal counts; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED, LONGEST_REMEMBERED = 300_000, 48
RESULT = "n_tokens long, score double"


class Counter:
    """Counts pieces of texts for one vocabulary of (piece, score)."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.singles = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        letters = set().union(*(p for p, _ in vocabulary)) if vocabulary else set()
        apart = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in letters)
        if any(MARK in p.lstrip(MARK) for p, _ in vocabulary):  # then only those breaks are safe
            self.parts = re.compile(f"[{apart}]|[^{apart}]+") if apart else re.compile("(?s).+")
        else:
            self.parts = re.compile(f"[{apart}]|{MARK}*[^{apart}{MARK}]+|{MARK}+")
        self.known: dict[str, tuple[int, float]] = {}

    def solve(self, part: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation of a part."""
        size = len(part)
        ending: list[list] = [[] for _ in range(size + 1)]
        for end, found in self.automaton.iter(part) if len(self.automaton) else ():
            ending[end + 1].append(found)  # the longest first
        score, count = [0.0] * (size + 1), [0] * (size + 1)
        for e in range(1, size + 1):
            best, pieces = None, 0
            for length, s in ending[e]:
                s += score[e - length]
                if best is None or s > best:
                    best, pieces = s, count[e - length] + 1
            if part[e - 1] not in self.singles:
                s = score[e - 1] + self.unknown
                if best is None or s > best:
                    best, pieces = s, count[e - 1] + len(part[e - 1].encode())
            score[e], count[e] = best, pieces
        return count[size], score[size]

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        pieces, total, known = 0, 0.0, self.known
        for part in self.parts.findall(MARK + text.replace(" ", MARK)):
            found = known.get(part)
            if found is None:
                found = self.solve(part)
                if len(part) <= LONGEST_REMEMBERED:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = found
            pieces += found[0]
            total += found[1]
        return pieces, total


def piece_file(path: str) -> list[tuple[str, float]]:
    """Pieces of text and their scores of a piece model; control and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))
    ]


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(piece_file(path))


def token_counts(text: Column, path: str) -> Column:
    """A struct ``n_tokens, score`` of a text column, for the vocabulary file at ``path``."""

    @F.pandas_udf(RESULT)
    def counted(texts: pd.Series) -> pd.DataFrame:
        counter = _counter(path)
        return pd.DataFrame([counter.count(t) for t in texts], columns=["n_tokens", "score"])

    return counted(text)
