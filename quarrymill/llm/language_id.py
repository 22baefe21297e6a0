"""Language identification by compression.

Each language has a raw-content zstandard dictionary of sample text.  A text is
encoded whole with every dictionary, in blocks that each begin with the dictionary
afresh, so that it is within the encoder's window all along; the one that gives the
fewest bytes names the language.  A narrow margin between the best two is a rejection.  Dictionaries
and texts are lower-cased, so that capitals find their match.  A run of line breaks
goes before each block: the format stores a block that hardly shrinks as it is, and
would give a short text the same size for all languages.

Defined results: null, empty and letterless texts are ``und`` with score 0 and
rejected; a table without any labelled text gives ``und`` for all rows; equal
sizes are decided by the language's code point order and rejected; where there is one
language, its rival is the encoding without a dictionary; repeated rows get equal answers; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarrymill.llm.common import fresh, quoted, small_batches

UNDETERMINED = "und"
LEAD = b"\n" * 64
TYPICAL_BYTES = 4_000  # of a text, by which the encoder sizes its tables
BLOCK = 1 << 16  # bytes of a text encoded at once: dictionary and block fit the window of 2^18
LETTER = regex.compile(r"\p{L}")
RESULT = "lang_pred string, score double, margin int, accepted boolean"


@dataclass(frozen=True)
class Bounds:
    """Bounds of the fitted sample and the rule of rejection.

    ``documents`` distinct texts per language are sampled, ``chars`` code points of each,
    ``dictionary`` bytes of them kept; all dictionaries together hold at most
    ``model`` bytes.  ``margin`` is the least difference, in bytes, between the
    best two encodings, and ``share`` the least in parts of the best one, so that a long
    text needs more evidence than a short one.  Margins of held-out rows of sf0.1 set it: 99 % of
    the texts in a learned language are wider, over 95 % of those in others are not.
    ``level`` is the compression level.
    """

    documents: int = 400
    chars: int = 1_000
    dictionary: int = 1 << 17
    model: int = 1 << 25
    margin: int = 1
    share: float = 0.03
    level: int = 9


def fit(df: DataFrame, text_col: str = "text", label_col: str = "lang", bounds: Bounds = Bounds()) -> dict[str, bytes]:
    """Dictionaries by language from a bounded sample of labelled texts.

    The distinct texts of each language are counted first (by a sketch), so that only about twice the wanted number, those
    with the smallest hashes, leave the scan, however large the language is and however often a text is
    repeated.  Of a text longer than ``bounds.chars`` a slice is taken that begins where another hash says.  What a
    dictionary has no room for is not collected: the driver gets ``bounds.model`` bytes and at most one slice per language.
    """
    rows = df.select(quoted(label_col).alias("lang"), quoted(text_col).alias("text")).where(
        "lang is not null and text is not null and text <> ''")
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("text").alias("n")).collect()  # one row per language, as the model has
    if not counts:
        return {}
    # a literal map, not a join: the rows that are not drawn are dropped in the scan
    most = {r["lang"]: min(1.0, (2.0 * bounds.documents + 100) / max(1, r["n"])) * (1 << 63) for r in counts}
    limit = F.create_map(*[F.lit(x) for pair in sorted(most.items()) for x in pair])
    drawn = rows.withColumn("draw", F.shiftrightunsigned(F.xxhash64(F.lit(7), "text"), 1)).where(
        F.col("draw") <= F.element_at(limit, F.col("lang")))
    spare = F.greatest(F.char_length("text") - bounds.chars, F.lit(0))
    begin = (F.pmod(F.xxhash64(F.lit(11), "text"), spare + 1) + 1).cast("int")
    slices = drawn.groupBy("lang", "draw").agg(F.min(F.substring("text", begin, F.lit(bounds.chars))).alias("text"))
    first = Window.partitionBy("lang").orderBy("draw")
    each = min(bounds.dictionary, bounds.model // len(counts))
    before = F.sum(F.octet_length("text") + 1).over(first.rowsBetween(Window.unboundedPreceding, -1))
    sample = slices.withColumns({"place": F.row_number().over(first), "before": F.coalesce(before, F.lit(0))}).where(
        (F.col("place") <= bounds.documents) & (F.col("before") < each))
    texts: dict[str, list] = {}
    for row in sample.select("lang", "place", "text").collect():
        texts.setdefault(row["lang"], []).append((row["place"], row["text"]))
    return {
        lang: "\n".join(t for _, t in sorted(found)).lower().encode()[:each]
        for lang, found in sorted(texts.items())
    }


@lru_cache(maxsize=4)
def _encoders(model: tuple[tuple[str, bytes], ...], level: int) -> tuple[list[str], list]:
    """Languages and their encoders; one without a dictionary, which has no name, follows a single language."""
    names, encoders = [], []
    for lang, data in model:
        known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            level, source_size=TYPICAL_BYTES, dict_size=len(data), write_checksum=False,
            write_content_size=False, write_dict_id=False)
        known.precompute_compress(compression_params=settings)
        names.append(lang)
        encoders.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=known))
    if len(names) == 1:
        settings = zstandard.ZstdCompressionParameters.from_level(
            level, source_size=TYPICAL_BYTES, write_checksum=False, write_content_size=False, write_dict_id=False)
        encoders.append(zstandard.ZstdCompressor(compression_params=settings))
    return names, encoders


def _sizes(text: str, encoders: list) -> np.ndarray:
    """Bytes of a text with every encoder, over all its blocks."""
    data = text.lower().encode()
    blocks = [LEAD + data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
    return np.array([sum(len(e.compress(b)) for b in blocks) for e in encoders])


def classify(texts, model: dict[str, bytes], bounds: Bounds = Bounds()) -> list[tuple]:
    """``(language, score, margin in bytes, accepted)`` per text.

    The score is the best language's share when every encoding of ``b`` bytes
    weighs two to the power of ``-8 b / 16``: sixteen saved bits per factor of two keep
    short texts, whose bytes are few, away from certainty.
    """
    names, encoders = _encoders(tuple(model.items()), bounds.level)
    out = []
    for text in texts:
        if not text or not names or not LETTER.search(text):
            out.append((UNDETERMINED, 0.0, 0, False))
            continue
        every = _sizes(text, encoders)
        sizes = every[: len(names)]
        best = int(sizes.argmin())
        weights = np.exp2((sizes[best] - sizes) / 2.0)
        margin = max(0, int(np.delete(every, best).min() - sizes[best]))
        accepted = margin >= max(bounds.margin, bounds.share * float(sizes[best]))
        out.append((names[best], float(1.0 / weights.sum()), margin, accepted))
    return out


def predict(text: Column, model: dict[str, bytes], bounds: Bounds = Bounds()) -> Column:
    """A struct ``lang_pred, score, margin, accepted`` of a text column."""

    @F.pandas_udf(RESULT)
    def language(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            classify(texts, model, bounds), columns=["lang_pred", "score", "margin", "accepted"]
        )

    return language(text)


def accepted_only(df: DataFrame, model: dict[str, bytes], text_col: str = "text",
                  bounds: Bounds = Bounds()) -> DataFrame:
    """Rows whose language is told with a sufficient margin; all columns stay."""
    (mark,) = fresh(df, "language")
    marked = small_batches(df).withColumn(mark, predict(quoted(text_col), model, bounds))
    return marked.where(F.col(f"{mark}.accepted")).drop(mark)
