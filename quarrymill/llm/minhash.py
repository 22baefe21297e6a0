"""One-permutation MinHash fingerprints with optimal densification and b-bit storage.

The shingles of a text are hashed once.  The high bits of a hash choose a bin, a
bin keeps its smallest hash.  An empty bin takes the value of a filled one:
every bin has its own order of probing, an affine permutation of the bins that
starts at itself, and the first filled bin in that order gives the value.  The
order depends on the bin alone, so equal sets of shingles are filled alike.
Only the low ``BITS`` bits of each bin are stored; two unrelated bins agree in
them with probability ``2 ** -BITS``, which the likeness corrects for.

Only DataFrame functions are used.  A fingerprint is computed inside the row: no
shingle is shuffled.

Defined results: null counts as the empty text; a text without words has the
fingerprint of zeros, is like another of its kind (1) and like nothing else (0,
up to chance); fewer words than a shingle are one shingle; equal texts and
repeated rows have equal fingerprints; rows with equal ids follow each other in
the order of their texts; null ids come first; the only row of a table is its own
next one; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import BLANK_CHARS, BLANKS, let, quoted, written

SHINGLE, BIN_BITS, BITS = 5, 7, 8
BINS = 1 << BIN_BITS
ROWS_PER_CHUNK, OVERSAMPLE = 4_096, 8


def _words(text: Column) -> Column:
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANK_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{BLANKS}]+"))


def _shingles(text: Column, width: int) -> Column:
    """One hash per shingle: the words' hashes, hashed together in order."""

    def combine(w: Column) -> Column:
        size = F.size(w)
        last = F.greatest(size - width, F.lit(0))
        inner = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]),
        )
        return F.when(size == 0, F.array().cast("array<bigint>")).otherwise(inner)

    return let(F.transform(_words(text), lambda w: F.xxhash64(w)), combine)


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BIN_BITS).cast("int")


def _multiplier(i: Column) -> Column:
    """An odd number per bin: the inverse of the step of its probing order."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(29), i), 40).cast("int").bitwiseOR(F.lit(1)).bitwiseAND(F.lit(BINS - 1))


def bins(text: Column, width: int = SHINGLE) -> Column:
    """The ``BINS`` low-order values of a text, all bins filled; zeros without words."""

    def smallest(h: Column) -> Column:
        return F.filter(h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, i - 1))))

    def dense(kept: Column) -> Column:
        at = F.transform(kept, _bin)
        low = F.transform(kept, lambda x: x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))
        known = F.map_from_arrays(at, low)

        def borrow(i: Column) -> Column:
            # place of each filled bin in the probing order of bin i, then its value
            reached = F.transform(kept, lambda x: F.shiftleft(
                (_multiplier(i) * (_bin(x) - i)).bitwiseAND(F.lit(BINS - 1)), BITS
            ).bitwiseOR(x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")))
            return F.array_min(reached).bitwiseAND(F.lit((1 << BITS) - 1))

        return let(known, lambda m: F.transform(
            F.sequence(F.lit(0), F.lit(BINS - 1)),
            lambda i: F.coalesce(F.try_element_at(m, i), borrow(i), F.lit(0)),
        ))

    return let(F.sort_array(_shingles(text, width)), lambda h: let(smallest(h), dense))


def packed(values: Column) -> Column:
    """Hexadecimal text of the bins, ``BITS / 4`` digits each."""
    digits = BITS // 4
    return F.lower(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), digits, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two rows of bins, corrected for chance, 0 to 1."""
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
    )
    chance = 1.0 / (1 << BITS)
    return F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1.0 - chance))


def _with_chunk(df: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Add ``chunk``: the number of cut points at or below ``doc_id``; -1 for null.

    The cut points are every eighth of the ids that a hash draws, one row in
    ``rows_per_chunk / 8``: one number per range of about so many rows, sorted in a
    scalar subquery and found by binary search.
    """
    one_in = max(1, rows_per_chunk // OVERSAMPLE)
    step = max(1, rows_per_chunk // one_in)
    drawn = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(one_in)) == 0
    points = df.select("doc_id").where(drawn & F.col("doc_id").isNotNull()).agg(
        F.filter(F.sort_array(F.collect_set("doc_id")), lambda _, i: (i + 1) % step == 0).alias("points")).scalar()
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])

    def search(found: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda low, s: F.when(
            F.get(found, low + s - 1) <= F.col("doc_id"), low + s).otherwise(low))

    return df.withColumn("points", points).withColumn(
        "chunk", F.when(F.col("doc_id").isNull(), -1).otherwise(let(F.col("points"), search))
    ).drop("points")


def with_next(df: DataFrame, add: Callable[[DataFrame], DataFrame], fields: list[str],
              rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add ``next``, a struct of ``fields`` of the row after, by ``doc_id``; the last
    row is followed by the first.

    ``add`` computes what ``fields`` name from ``doc_id`` and ``text``.  The table
    is cut in ranges of ids; a row moves once, to the task of its range.  The last
    row of a range takes the first row of the next one, which is fetched by its id.
    """
    inside = Window.partitionBy("chunk").orderBy(F.col("doc_id").asc_nulls_first(), F.col("text"))
    following = F.struct(*fields)
    rows = add(_with_chunk(df, rows_per_chunk)).withColumns({
        "next": F.lead(following).over(inside),
        "last": F.lead(F.lit(1)).over(inside).isNull(),
    })
    across = Window.orderBy("chunk")  # one row per range
    turn = _with_chunk(df.select("doc_id"), rows_per_chunk).groupBy("chunk").agg(
        F.min("doc_id").alias("first_id")
    ).select("chunk", F.when(
        F.lead("chunk").over(across).isNotNull(), F.lead("first_id").over(across)
    ).otherwise(F.first("first_id").over(across.rowsBetween(Window.unboundedPreceding, 0))).alias("want"))
    turn = written(turn.withColumnRenamed("chunk", "turn"), "range-firsts")
    heads = df.join(turn, F.col("doc_id").eqNullSafe(F.col("want"))).groupBy("turn", "doc_id").agg(
        F.min("text").alias("text"))
    heads = add(heads).select("turn", following.alias("head"))
    return rows.join(heads, F.col("chunk") == F.col("turn"), "left").withColumn(
        "next", F.when(F.col("last"), F.col("head")).otherwise(F.col("next"))
    ).drop("chunk", "last", "turn", "head")


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by as many first ones of the next text."""
    size = F.char_length(text)
    part = F.floor(size / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - part), F.substring(following, F.lit(1), part))


def fingerprints(df: DataFrame, text_col: str = "text", name: str = "bins", width: int = SHINGLE) -> DataFrame:
    """``df`` with the bins of a text column: the general operator."""
    return df.withColumn(name, bins(quoted(text_col), width))


def compare_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    texts = df.select(quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    rows = with_next(texts, fingerprints, ["text", "bins"], rows_per_chunk)
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next.text")))
    return fingerprints(rows, "edited", "edited_bins").select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next.bins")).alias("near_next"),
    )
