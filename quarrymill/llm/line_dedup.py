"""Lines that many documents share are dropped from all of them.

Defined results: a null or empty text is one empty line and stays ``''``; a key
shorter than ``min_chars`` is never dropped; every row counts as one document,
also where an id repeats or is null, unless ``per_text`` counts equal texts once; an empty table gives an empty one; columns
that clash with the ones made here are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import BLANK_CHARS, ascii_lower, fresh, let, quoted, written

MIN_CHARS, MIN_DOCUMENTS = 1, 10


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key(line: Column) -> Column:
    """The line stripped of blanks, with A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANK_CHARS)))


def _hash(k: Column) -> Column:
    """128 bits, so that no two of 10^13 lines are likely to meet."""
    return F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit(17), k).alias("b"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
          outputs: tuple[str, str, str] = ("kept", "n_lines", "n_dropped"), per_text: bool = False) -> DataFrame:
    """All columns of ``df`` and ``outputs``: the kept text, lines before, lines dropped.

    Only hashes of the distinct lines of a document are exploded.  Counting
    them per hash is combined before the shuffle, so a line of every document is
    one row per task.  The frequent ones go back to the documents that hold
    them, and only then are texts shuffled, once, to meet their list; the planner
    may broadcast the lists instead where they are small.  A document is known by its id and a hash of
    its text, so rows without an id, or with one id, spread out.  In the document the
    lines are taken in order of position.  With ``per_text`` copies of one whole text
    count as one document: those of the lines that many rows hold are counted again by text.
    """
    usable = F.filter(F.transform(lines(quoted(text_col)), key), lambda k: F.char_length(k) >= min_chars)
    hashed = written(
        df.select(
            quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("tag"), *([_hash(quoted(text_col)).alias("whole")] if per_text else []),
            F.array_distinct(F.transform(usable, _hash)).alias("hashes"),
        ).where(F.size("hashes") > 0),
        "line-hashes",
    )
    single = hashed.select("id", "tag", F.explode("hashes").alias("h"))
    frequent = (
        single.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_documents).select("h")
    )
    frequent = written(frequent, "frequent-lines")
    if per_text:
        texts = hashed.select("whole", F.explode("hashes").alias("h")).join(frequent, "h").distinct()
        frequent = written(
            texts.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_documents).select("h"),
            "frequent-in-texts")
    doomed, mine, my_tag, all_lines, left = fresh(df, "doomed", "mine", "tag", "lines", "left")
    lists = single.join(frequent, "h").groupBy("id", "tag").agg(F.collect_set("h").alias(doomed))
    lists = lists.withColumnsRenamed({"id": mine, "tag": my_tag})
    same = quoted(id_col).eqNullSafe(F.col(mine)) & (F.xxhash64(quoted(text_col)) == F.col(my_tag))
    joined = df.join(lists, same, "left")
    none = F.col(doomed).isNull()

    def stays(line):
        return let(key(line), lambda k: (F.char_length(k) < min_chars)
                   | ~F.array_contains(F.col(doomed), _hash(k)))

    cut = joined.withColumn(all_lines, lines(quoted(text_col))).withColumn(
        left, F.when(none, F.col(all_lines)).otherwise(F.filter(F.col(all_lines), stays))
    )
    kept, n_lines, n_dropped = outputs
    return cut.select(
        *[quoted(c) for c in df.columns],
        F.array_join(left, "\n").alias(kept),
        F.size(all_lines).cast("bigint").alias(n_lines),
        (F.size(all_lines) - F.size(left)).cast("bigint").alias(n_dropped),
    )


def replace_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length_col: str = "n_chars", min_chars: int = MIN_CHARS,
                 min_documents: int = MIN_DOCUMENTS, per_text: bool = False) -> DataFrame:
    """``df`` with the kept lines as its text, and the length to match; no row goes."""
    made = fresh(df, "kept", "n_lines", "n_dropped")
    cut = dedup(df, id_col, text_col, min_chars, min_documents, tuple(made), per_text)
    changed = {text_col: F.when(quoted(text_col).isNull(), F.lit(None)).otherwise(F.col(made[0]))}
    if length_col in df.columns:
        same = F.col(made[2]) == 0
        kind = df.schema[length_col].dataType
        changed[length_col] = F.when(same, quoted(length_col)).otherwise(F.char_length(made[0]).cast(kind))
    return cut.withColumns(changed).drop(*made)
