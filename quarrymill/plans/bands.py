"""Equi-join forms of range and sum conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def band_join(
    left: DataFrame, right: DataFrame, left_value: str, right_value: str,
    low: int, high: int,
) -> DataFrame:
    """Pairs with ``low <= right_value - left_value <= high`` (whole numbers).

    The value axis is cut into cells as wide as the band; a left row is sent to
    the two or three cells its band touches and meets the right rows there by
    an equi-join, so a band of any width costs the same few copies.
    """
    width = high - low + 1
    lo = F.col(left_value) + low
    hi = F.col(left_value) + high
    cells = left.withColumn(
        "_cell", F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width)))
    )
    keyed = right.withColumn("_cell", F.floor(F.col(right_value) / width))
    return (
        cells.join(keyed, "_cell")
        .where((F.col(right_value) - F.col(left_value)).between(low, high))
        .drop("_cell")
    )


def value_counts(df: DataFrame, value: str | Column, name: str = "v") -> DataFrame:
    """Distinct non-null values with their counts: the reduced side of sum joins."""
    col = F.col(value) if isinstance(value, str) else value
    return (
        df.select(col.alias(name)).where(F.col(name).isNotNull())
        .groupBy(name).agg(F.count("*").alias("n"))
    )
