"""Plain text: lines, blank-line separated records, and line parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One trimmed line per row (``value``); blank lines are dropped.

    Line numbers do not exist across files and splits: a file whose order
    matters has to carry an index in its text.
    """
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records separated by blank lines, line breaks inside a record as blanks.

    Splitting happens in the reader (``lineSep``), so a large file is still
    read by many tasks.  Empty records from doubled blank lines are dropped.
    The first line tells whether the files have Windows line ends.
    """
    first = spark.read.option("lineSep", "\n").text(path).head()
    end = "\r\n" if first is not None and first[0].endswith("\r") else "\n"
    raw = spark.read.option("lineSep", end * 2).text(path)
    joined = F.trim(F.regexp_replace(F.col("value"), r"\s*\n\s*", " "))
    return raw.select(joined.alias("record")).where("record <> ''")


def write_text(df: DataFrame, column: str, path: str, separator: str = "\n") -> str:
    df.select(F.col(column).alias("value")).write.mode("overwrite").option(
        "lineSep", separator
    ).text(path)
    return path


def regex_struct(text: Column, pattern: str, fields: dict[str, str]) -> list[Column]:
    """One typed column per capture group; null where the line does not match."""
    hit = text.rlike(pattern)
    return [
        F.when(hit, F.regexp_extract(text, pattern, i)).cast(kind).alias(name)
        for i, (name, kind) in enumerate(fields.items(), start=1)
    ]


def rule_edges(df: DataFrame, line: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``"X bags contain 2 Y bags, 3 Z bags."`` to rows ``(parent, child, qty)``.

    A rule with nothing inside (``no other bags``) keeps its parent with a null
    child and quantity, so the node is not lost.
    """
    text = F.col(line)
    inside = r"(\d+) ([^,.]+?) bags?(?=[,.])"
    # the head may hold digits of its own, so only the part behind it is searched
    body = F.regexp_replace(text, "^.*? bags contain ", "")
    pairs = F.arrays_zip(
        F.regexp_extract_all(body, F.lit(inside), F.lit(1)).alias("qty"),
        F.regexp_extract_all(body, F.lit(inside), F.lit(2)).alias("child"),
    )
    return df.select(
        *keep,
        F.regexp_extract(text, r"^(.*?) bags contain", 1).alias("parent"),
        F.explode_outer(pairs).alias("item"),
    ).select(*keep, "parent", F.col("item.child").alias("child"), F.col("item.qty").cast("bigint").alias("qty"))


def instruction(text: Column) -> list[Column]:
    """``"acc +6"`` to its word and signed number."""
    words = F.split(text, " ")
    return [words[0].alias("word"), words[1].cast("bigint").alias("arg")]
