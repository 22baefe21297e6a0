"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.session import cut_lineage, written

BLANKS = r"\x20\x09-\x0D"
WORD = f"[^{BLANKS}]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 512


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's rows per Arrow batch to 512 for workers that take whole texts.

    A batch lies in memory in the executor and in its Python worker at once, and texts may be long.
    """
    conf = df.sparkSession.conf
    now = int(conf.get(BATCH_SETTING, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names close to ``wanted`` that ``df`` does not hold in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        made = f"_{name}"
        while made.lower() in taken:
            made = f"_{made}"
        taken.add(made.lower())
        out.append(made)
    return out


def quoted(name: str) -> Column:
    """A top-level column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it.

    The optimizer may copy a projected expression into a lambda, where it would
    run again for every element; a lambda variable cannot be copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of ``WORD`` matches; null counts zero."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def components(edges: DataFrame, low: str = "u", high: str = "v") -> DataFrame:
    """``(node, root)`` for every node of an undirected graph of 64-bit nodes.

    Large-star and small-star steps alternate until the edges are stars around
    the smallest node of each component.  Every step is one minimum per node
    (combined before the shuffle) and one equality join, which adaptive planning
    splits where a node has very many edges; the edge count never grows beyond
    the first round's, and no path or group is gathered in one task.  Each
    round is checkpointed in the shared folder.
    """
    now = cut_lineage(
        edges.select(F.least(low, high).alias("u"), F.greatest(low, high).alias("v"))
        .where("u <> v").distinct()
    )
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").distinct()
        )
        # small star: edges run from the larger node v to smaller ones
        below = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(below, "v").select(
            F.explode(F.array(F.struct("m", F.col("v").alias("x")), F.struct("m", F.col("u").alias("x")))).alias("e")
        ).select(F.col("e.m").alias("u"), F.col("e.x").alias("v")).where("u <> v").distinct()
        now = cut_lineage(small)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    nodes = now.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return nodes.union(now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))")).first()
    return tuple(row)
