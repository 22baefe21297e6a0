"""Group summaries, counts over columns, histograms and densities."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from math import factorial, pi
from operator import mul

from numpy.polynomial.hermite_e import herme2poly
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.operators import project
from quarrymill.plans import chunked


def counts(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def shares(df: DataFrame, *keys: str) -> DataFrame:
    """Counts with their share of all rows; the total is one scalar of the counts."""
    n = counts(df, *keys)
    total = n.agg(F.sum("n").alias("t"))
    return n.withColumn("prop", F.col("n") / total.scalar())


def cross_counts(
    df: DataFrame, rows: str, columns: str, levels: Sequence, prefix: str = "", other: str | None = "other"
) -> DataFrame:
    """Counts of ``rows`` against the stated ``levels`` of ``columns``, zero where absent.

    Rows of any other level, null included, are counted under ``other``; with ``other=None`` they are left out.
    """
    level = F.col(columns)
    counted = [F.count_if(level == F.lit(v)).alias(f"{prefix}{v}") for v in levels]
    if other is not None:
        counted.append(F.count_if(level.isNull() | ~level.isin(list(levels))).alias(f"{prefix}{other}"))
    return df.groupBy(rows).agg(*counted)


def ratio_of_sums(df: DataFrame, keys: Sequence[str], top: str, bottom: str) -> DataFrame:
    """Sums that skip nulls (an all-null group sums to zero) and their ratio, null over zero."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    return (
        df.groupBy(*keys).agg(total(top).alias("top"), total(bottom).alias("bottom"))
        .withColumn("ratio", F.try_divide("top", "bottom"))
    )


def _long_values(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``(column, value)`` with every value as text."""
    names = list(names)
    return df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot(
        [], names, "column", "value"
    )


def distinct_per_column(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Distinct values of each column, a missing value counting as one of them.

    Long form with ``distinct`` first: duplicates vanish before the shuffle and
    one wide column is spread over all tasks.
    """
    long = _long_values(df, df.columns if names is None else names).distinct()
    return long.groupBy("column").agg(F.count("*").alias("n_distinct"))


def levels_per_factor(df: DataFrame) -> DataFrame:
    """Levels of each text column (missing is no level) and the indicators they need."""
    long = _long_values(df, project.text_columns(df)).where("value IS NOT NULL").distinct()
    return long.groupBy("column").agg(
        F.count("*").alias("num_levels"), (F.count("*") - 1).alias("num_indicators")
    )


def missing_per_column(df: DataFrame) -> DataFrame:
    """Count and share of missing values for the columns that have any."""
    found = project.null_counts(df).where("num_missing > 0")
    return found.select("column", "num_missing", (F.col("num_missing") / F.col("n_rows")).alias("prop_missing"))


def product(df: DataFrame, value: str) -> DataFrame:
    """Product of a column as a whole number; exact while it stays below 2^53."""
    return df.agg(F.round(F.product(F.col(value))).cast("bigint").alias("product"))


def letter_sets(df: DataFrame, group: str, text: str) -> DataFrame:
    """Per group: letters used by any member and letters used by every member.

    A member's letters are made distinct inside its row, so the exploded rows are
    at most one per letter, and counting rows per letter counts members.  Groups
    that share no letter keep a zero.
    """
    letters = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit("([a-z])"), F.lit(1)))
    members = df.groupBy(group).agg(F.count("*").alias("members"))
    used = (
        df.select(group, F.explode(letters).alias("letter"))
        .groupBy(group, "letter").agg(F.count("*").alias("used_by"))
    )
    there = used.withColumnRenamed(group, "_group")
    return (
        members.join(there, F.col(group).eqNullSafe(F.col("_group")), "left").groupBy(group, "members")
        .agg(F.count("letter").alias("any_member"),
             F.count_if(F.col("used_by") == F.col("members")).alias("every_member"))
    )


def bin_right_closed(value: Column, width: float) -> Column:
    """Centre of a bin centred on multiples of ``width`` and closed on the right."""
    return F.ceil((value - F.lit(width / 2)) / F.lit(width)) * F.lit(width)


def histogram(df: DataFrame, value: str, width: float) -> DataFrame:
    return counts(df.where(F.col(value).isNotNull()), bin_right_closed(F.col(value), width).alias("bin"))


DENSITY_TERMS, DENSITY_REACH = 10, 9  # last power of the moments; bandwidths beyond which a cell adds less than 1e-16


def density(df: DataFrame, value: str, points: int, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density of a column on an even grid, with the column's mean.

    Five scalars fix the grid and the bandwidth ``h`` (``sd * n^(-1/5)`` by default).  Values are summed up
    in cells half a bandwidth wide: the count and the moments ``sum(d^j)``, ``d = (x - centre) / h``, up to j = 10.  A cell's
    part of the density at distance ``u`` (in h) is the series ``exp(-u^2/2) * sum_j He_j(u) * sum(d^j) / j!``, for the grid
    points within nine bandwidths only.  So work beyond the one scan grows with the range over the bandwidth, not with
    distinct values times points.  As ``|d| <= 1/4`` and ``|He_j(u)| exp(-u^2/4) <= 1.09 sqrt(j!)``, what the series leaves
    out is below ``5e-11`` of the kernel's peak, ``5e-11 / (h * sqrt(2 pi))`` in the result.

    A column of one value has no spread: its grid is that value and the
    density there, a point mass, is null; an empty column gives no row.
    """
    x = F.col(value)
    low, high, sd, n, mean = df.agg(
        F.min(x), F.max(x), F.stddev_samp(x), F.count(x), F.avg(x)
    ).first()
    if not n:
        low = high = mean = 0.0
    h = float(bandwidth or (sd or 0.0) * max(n, 1) ** (-1 / 5))
    if not n or not h:
        rows = df.sparkSession.range(1 if n else 0).select(F.lit(0).alias("grid_no"), F.lit(float(low)).alias("grid_x"))
        return rows.withColumns({"density": F.lit(None).cast("double"), "mean": F.lit(float(mean))})
    low, high = float(low), float(high)
    step = (high - low) / max(1, points - 1)
    cell = F.floor((x.cast("double") - low) / (h / 2))
    centre = low + (F.col("_cell") + 0.5) * (h / 2)
    powers = range(DENSITY_TERMS + 1)
    d = F.col("_d")
    cells = (
        df.where(x.isNotNull()).select(cell.alias("_cell"), x.cast("double").alias("_x"))
        .withColumn("_d", (F.col("_x") - centre) / h)
        .groupBy("_cell").agg(*[F.sum(reduce(mul, [d] * j, F.lit(1.0))).alias(f"_m{j}") for j in powers])
    )
    # the series as a polynomial in u: its coefficients per cell
    basis = [herme2poly([0.0] * j + [1.0 / factorial(j)]) for j in powers]
    cells = cells.select(centre.alias("_centre"), *[
        sum((F.col(f"_m{j}") * float(basis[j][k]) for j in powers if k < len(basis[j]) and basis[j][k]), F.lit(0.0)).alias(f"_c{k}")
        for k in powers])
    if step:
        first = F.greatest(F.ceil((F.col("_centre") - DENSITY_REACH * h - low) / step), F.lit(0))
        last = F.least(F.floor((F.col("_centre") + DENSITY_REACH * h - low) / step), F.lit(points - 1))
        near = F.when(first <= last, F.sequence(first, last))
    else:
        near = F.sequence(F.lit(0), F.lit(points - 1))
    u = (low + F.col("_no") * step - F.col("_centre")) / h
    series = reduce(lambda total, k: total * u + F.col(f"_c{k}"), reversed(powers), F.lit(0.0))
    sums = cells.withColumn("_no", F.explode(near)).groupBy(F.col("_no").cast("bigint").alias("_no")).agg(
        F.sum(F.exp(-0.5 * u * u) * series).alias("_k"))
    scale = 1 / (n * h * (2 * pi) ** 0.5)
    grid = df.sparkSession.range(points)
    return grid.join(sums, grid.id == sums["_no"], "left").select(
        F.col("id").cast("int").alias("grid_no"), (low + F.col("id") * step).alias("grid_x"),
        (F.coalesce("_k", F.lit(0.0)) * scale).alias("density"), F.lit(mean).alias("mean"))


def score_summary(df: DataFrame, score: str) -> DataFrame:
    """Mean and spread of fold scores, in both conventions for the spread."""
    return df.agg(
        F.round(F.avg(score), 4).alias("mean"),
        F.round(F.stddev_pop(score), 4).alias("sd_population"),
        F.round(F.stddev_samp(score) / F.sqrt(F.count(score)), 4).alias("std_err"),
    )


def difference_histogram(df: DataFrame, value: str, start: int = 0, last_step: int = 3) -> DataFrame:
    """Counts of steps between successive distinct values, from ``start`` and with a final step."""
    distinct = chunked.with_chunks(df.select(value).distinct(), value, measure=df)
    steps = chunked.previous(distinct, [], [value], {"_before": value}).select(
        (F.col(value) - F.coalesce("_before", F.lit(start))).cast("bigint").alias("step")
    )
    ending = df.sparkSession.range(1).select(F.lit(last_step).cast("bigint").alias("step"))
    return counts(steps.union(ending), "step")
