"""Sorting, limits with stated tie rules, repeatable sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.hashing import hash_int, hash_text
from quarrymill.plans import chunked


def top_with_ties(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose value is among the ``n`` largest, ties at the end kept, nulls dropped.

    The n-th largest value is one scalar from a top-n sort; all rows from there
    up pass a plain filter, however many tie.
    """
    nth = (
        df.where(F.col(value).isNotNull()).select(F.col(value).alias("_v"))
        .orderBy(F.desc("_v")).limit(n).agg(F.min("_v").alias("m"))
    )
    return df.where(F.col(value) >= nth.scalar())


def first_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """Exactly ``n`` rows in a stated total order: a top-n per task, then one merge."""
    return df.orderBy(*order).limit(n)


def last_of_best(df: DataFrame, score: str, sequence: str) -> DataFrame:
    """Among the rows with the best score, the last in sequence."""
    return df.orderBy(F.desc(score), F.desc(sequence)).limit(1)


def by_custom_order(df: DataFrame, column: str, ordering: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Add the 1-based place of ``column`` in a stated order (null when not listed)."""
    places = F.array(*[F.lit(v) for v in ordering])
    return df.withColumn(name, F.nullif(F.array_position(places, F.col(column)), F.lit(0).cast("bigint")))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` random rows, the same ones for the same seed on any cluster."""
    return df.orderBy(hash_text(key, seed), key).limit(n)


def shuffled_replicates(df: DataFrame, key: str, replicates: int, seed: int = 0) -> DataFrame:
    """Random reorderings of the whole table: ``(rep, ...)`` with its shuffle key.

    The order inside a replicate is that of a digest, so it is uniform on
    [0, 1) and cuts into equal chunks without looking at the data.
    """
    # rows are spread before they multiply: one small file would otherwise be one task
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = df.repartition(tasks, key).withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    tag = F.concat(F.lit(f"{seed}-"), F.col("rep"))
    keyed = copies.withColumn("_draw", hash_int(key, tag))
    return chunked.with_uniform_chunks(keyed, F.col("_draw") / F.lit(4294967296.0), df.count())
