"""Fuzzy search for short licence notices.

A text is reduced to lower-case words joined by single blanks.  A notice with up to
``k`` edits is cut into ``k + 1`` seeds, of which an occurrence must keep one
exactly.  One Aho-Corasick automaton finds the seeds of all notices in a single pass
over the whole text; around each hit the ``regex`` library verifies the notice with
bounded errors and gives the span.  Exact phrases are notices without edits
whose seed, the phrase between blanks, is all there is to verify.

Defined results: null and empty texts have no words and no match; overlapping places
of a phrase all count; several seeds of one occurrence give one match; equal texts
give equal rows; very long texts are scanned whole in one pass; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<label:string,exact:boolean,first_word:int,last_word:int,edits:int,likeness:double>"
RESULT = f"n_words long, spans array<{SPAN}>"
_LOWER = {c: c + 32 for c in range(65, 91)}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Notice:
    """``words`` joined by blanks, its label, and how many edits (insertions,
    deletions, substitutions of characters) are allowed."""

    label: str
    words: str
    edits: int = 0


PHRASES = (
    Notice("cc-by", "cc by"),
    Notice("gpl", "general public license"),
    Notice("reserved", "all rights reserved"),
)
NOTICES = (
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge", 3),
    Notice("apache-2.0", "licensed under the apache license version 2 0", 3),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("mpl-2.0", "subject to the terms of the mozilla public license", 4),
    Notice("gpl", "gnu general public license", 2),
    Notice("lgpl", "gnu lesser general public license", 2),
    Notice("cc-by", "creative commons attribution", 2),
    Notice("public-domain", "dedicated to the public domain", 2),
    Notice("reserved", "all rights reserved", 1),
)


def seeds(notice: Notice) -> list[tuple[str, int]]:
    """``edits + 1`` pieces of nearly equal length and where each starts."""
    text = f" {notice.words} " if not notice.edits else notice.words
    n = notice.edits + 1
    limits = [len(text) * i // n for i in range(n + 1)]
    return [(text[a:b], a) for a, b in zip(limits, limits[1:])]


class Scanner:
    def __init__(self, notices: tuple[Notice, ...]):
        found: dict[str, list] = {}
        self.notices = notices
        self.patterns = [
            regex.compile(f"(?:{regex.escape(n.words, literal_spaces=True)}){{e<={n.edits}}}", regex.BESTMATCH) if n.edits else None
            for n in notices
        ]
        for i, notice in enumerate(notices):
            for seed, start in seeds(notice):
                found.setdefault(seed, []).append((i, start))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in found.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple]]:
        """Number of words, and the matches in order of their place."""
        words = _WORD.findall(text.translate(_LOWER)) if text else []
        joined = f" {' '.join(words)} "
        matches: dict[tuple[int, int, int], int] = {}
        for end, (size, uses) in self.automaton.iter(joined):
            for i, start in uses:
                notice, at = self.notices[i], end - size + 1 - start
                if not notice.edits:  # the seed is the whole phrase between blanks
                    matches[(at + 1, at + 1 + len(notice.words), i)] = 0
                    continue
                low, high = max(0, at - notice.edits), at + len(notice.words) + notice.edits
                hit = self.patterns[i].search(joined, low, min(high, len(joined)))
                if hit:
                    key, edits = (hit.start(), hit.end(), i), sum(hit.fuzzy_counts)
                    matches[key] = min(edits, matches.get(key, edits))
        out, place, word = [], 0, -1
        for (a, b, i), edits in sorted(matches.items()):
            word += joined.count(" ", place, a + 1)  # blanks up to here
            place = a + 1
            notice = self.notices[i]
            first = min(max(word, 0), len(words) - 1)
            last = max(first, first + joined.count(" ", a + 1, b - 1))
            out.append((notice.label, not notice.edits, first, last, edits, 1.0 - edits / len(notice.words)))
        return len(words), out


@lru_cache(maxsize=4)
def _scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


def scan(text: Column, notices: tuple[Notice, ...] = PHRASES + NOTICES) -> Column:
    """A struct ``n_words, spans`` of a text column; a span names its label, its first and
    last word, whether it came from an exact phrase, and its edits."""

    @F.pandas_udf(RESULT)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        scanner = _scanner(notices)
        rows = [scanner.scan(t) for t in texts]
        names = ("label", "exact", "first_word", "last_word", "edits", "likeness")
        return pd.DataFrame({
            "n_words": [n for n, _ in rows],
            "spans": [[dict(zip(names, s)) for s in spans] for _, spans in rows],
        })

    return scanned(text)
