"""Reachability and roll-ups over edge tables ``(parent, child[, qty])``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.plans import bands, frontier


def ancestors(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Nodes that reach any of the targets (column ``node``), directly or not."""
    return frontier.reach(edges, targets, "child", "parent")


def items_below(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``(root, total)``: all items under each root, quantities multiplied down the tree.

    Leaves beside inner nodes count as well, which the original recursion missed.
    """
    start = roots.select("node", F.col("node").alias("root"), F.lit(1).cast("bigint").alias("mult"))
    below = frontier.weighted_reach(edges.where("child IS NOT NULL"), start, "parent", "child", "qty")
    return below.groupBy("root").agg(F.sum("mult").alias("total"))


def closure(edges: DataFrame) -> DataFrame:
    """Every ``(ancestor, descendant)`` pair."""
    return frontier.closure(edges, "parent", "child")


def neighbours(values: DataFrame, value: str, low: int, high: int, name: str) -> DataFrame:
    """For every value the sorted list of values in a band above or below it.

    Values are distinct, so a list cannot be longer than the band is wide; a
    value without neighbours keeps an empty list.
    """
    base = values.select(F.col(value).alias("v")).distinct()
    pairs = bands.band_join(base, base.withColumnRenamed("v", "_other"), "v", "_other", low, high)
    lists = pairs.groupBy("v").agg(F.array_sort(F.collect_list("_other")).alias(name))
    return base.join(lists, "v", "left").withColumn(
        name, F.coalesce(name, F.array().cast(lists.schema[name].dataType))
    )
