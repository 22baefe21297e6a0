"""Stacking, set algebra, and reshaping between wide and long."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(*tables: DataFrame) -> DataFrame:
    """Rows of all tables by column name; a column absent from one is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def unordered_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    """Each pair once, whichever way round it came."""
    return df.select(
        F.least(left, right).alias("low"), F.greatest(left, right).alias("high")
    ).distinct()


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], names_to: str, values_to: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), names_to, values_to)


def members(df: DataFrame, keep: Sequence[str], items: Column, name: str) -> DataFrame:
    """One row per list item."""
    return df.select(*keep, F.explode(items).alias(name))
