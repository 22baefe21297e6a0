"""Exact order statistics without gathering the values anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.plans import chunked
from quarrymill.plans.bands import value_counts


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One row ``median``: the middle value, or the mean of the two middle ones.

    The built-in exact median keeps every distinct value in one task.  Here the
    distinct values are counted, a running count places them, and only the one
    or two values that cover the middle are kept.
    """
    counts = value_counts(df, value)
    cut = chunked.with_chunks(counts, "v", measure=df.select(F.col(value).alias("v")))
    placed = chunked.running(cut, [], ["v"], {"upto": F.col("n")})
    total = counts.agg(F.sum("n")).scalar()
    low, high = F.floor((total + 1) / 2), F.ceil((total + 1) / 2)
    before = F.col("upto") - F.col("n")
    covers = lambda place: (place > before) & (place <= F.col("upto"))
    return placed.where(covers(low) | covers(high)).agg(F.avg("v").alias("median"))
