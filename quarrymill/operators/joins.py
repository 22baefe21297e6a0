"""Joins, and searches that are joins once written as equalities.

No join carries a broadcast hint here unless the small side is bounded by
construction: dimension tables are left to Spark's own size check.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.plans import bands, chunked


def rows_at_group_max(
    df: DataFrame, keys: Sequence[str], value: str, maxima_from: DataFrame | None = None
) -> DataFrame:
    """Rows that reach their group's maximum, ties kept.

    The maximum is a partial aggregate and the join key holds the value as well,
    so neither step gathers a large group in one place.  A null key is a group.  ``maxima_from`` takes
    the maxima from other rows (a filtered table) while all of ``df`` may match:
    a row that the filter left out comes back when its value equals the maximum.
    """
    named = {c: f"_top_{c}" for c in [*keys, value]}
    tops = (df if maxima_from is None else maxima_from).groupBy(*keys).agg(F.max(value).alias(value))
    tops = tops.select(*[F.col(c).alias(n) for c, n in named.items()])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(named[c])) for c in keys], F.col(value) == F.col(named[value]))
    return df.join(tops, same).drop(*named.values())


def last_state(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each group's row with the greatest ``order`` (which must not tie)."""
    row = F.struct(*[F.col(c) for c in columns])
    return (
        df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])
    )


def pair_sums(df: DataFrame, value: str | Column, target: int) -> DataFrame:
    """Unordered value pairs of two different rows that add up to ``target``.

    The table shrinks to distinct values with counts first; a value pairs with
    itself only when it occurs twice.
    """
    counts = bands.value_counts(df, value)
    low = counts.select(F.col("v").alias("low"), F.col("n").alias("_n"), (target - F.col("v")).alias("high"))
    high = counts.select(F.col("v").alias("high"))
    return (
        low.join(high, "high")
        .where((F.col("low") < F.col("high")) | ((F.col("low") == F.col("high")) & (F.col("_n") >= 2)))
        .select("low", "high", (F.col("low").cast("bigint") * F.col("high")).alias("product"))
    )


def triple_sums(df: DataFrame, value: str | Column, target: int) -> DataFrame:
    """Value triples ``a <= b <= c`` of three different rows that add up to ``target``.

    Whole numbers of any sign.  For each distinct ``a`` the possible ``b`` lie
    between ``a`` and ``(target - a) / 2``.  The range of the values is cut in
    about as many cells as the root of the number of distinct values; ``a`` goes to
    the cells its band meets and finds there, by an equi-join, only values that are in
    the table; ``c`` is a second equi-join.  The candidates depend on the values
    present, not on how large the target is.  (The original search let one row count twice.)
    """
    counts = bands.value_counts(df, value)
    a = counts.where(F.col("v") * 3 <= target).select(F.col("v").cast("bigint").alias("a"), F.col("n").alias("_na"))
    b = counts.select(F.col("v").cast("bigint").alias("b"), F.col("n").alias("_nb"))
    c = counts.select(F.col("v").cast("bigint").alias("c"))
    # a <= b <= (target - a) / 2: the band is cut in cells, and b is looked up in those that a's band meets
    spread = counts.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))).first()[0]
    if not spread["n"]:
        return a.select("a", F.col("a").alias("b"), F.col("a").alias("c"), F.col("a").alias("product")).limit(0)
    width = max(1, int((int(spread["high"]) - int(spread["low"])) / spread["n"] ** 0.5) + 1)
    low, high = int(spread["low"]), int(spread["high"])
    cell = lambda x: F.floor((x - low) / width)
    upper = F.least(F.floor((F.lit(target) - F.col("a")) / 2), F.lit(high))
    spans = a.where(upper >= F.col("a")).withColumn("_cell", F.explode(F.sequence(cell(F.col("a")), cell(upper))))
    ab = spans.join(b.withColumn("_cell", cell(F.col("b"))), "_cell").where(
        (F.col("b") >= F.col("a")) & (F.col("b") <= upper))
    need = F.lit(1) + (F.col("a") == F.col("b")).cast("int")
    need_c = F.col("b") == F.col("c")
    return (
        ab.withColumn("c", F.lit(target) - F.col("a") - F.col("b")).join(c, "c")
        .where((F.col("_na") >= need)
               & (~need_c | (F.col("_nb") >= F.when(F.col("a") == F.col("b"), 3).otherwise(2))))
        .select("a", "b", "c", (F.col("a") * F.col("b") * F.col("c")).alias("product"))
    )


def pair_sum_in_lookback(df: DataFrame, index: str, value: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """Is the value the sum of two different values among the ``n`` rows before it?

    ``index`` is gap-free from 1; the first ``n`` rows have no full frame and are left out.
    """
    framed = chunked.lookback(df, keys, index, n, {"_frame": lambda w: F.collect_list(value).over(w)})
    rest = lambda x: F.col(value) - x
    valid = F.exists("_frame", lambda x: F.array_contains("_frame", rest(x)) & (rest(x) != x))
    return framed.where(F.col(index) > n).withColumn("valid", valid).drop("_frame")


def single_gaps(df: DataFrame, ident: str) -> DataFrame:
    """Missing numbers whose two neighbours are both present: ``(low, missing, high)``.

    Each id votes for itself and for the numbers beside it, and a number with
    both neighbour votes but not its own is a gap: one aggregation instead of a
    self join and an anti join.
    """
    votes = F.explode(F.array(
        F.struct(F.col("_id").alias("missing"), F.lit(4).alias("vote")),
        F.struct((F.col("_id") + 1).alias("missing"), F.lit(1).alias("vote")),
        F.struct((F.col("_id") - 1).alias("missing"), F.lit(2).alias("vote")),
    ))
    return (
        df.select(F.col(ident).alias("_id")).select(votes.alias("v"))
        .groupBy("v.missing").agg(F.bit_or("v.vote").alias("votes"))
        .where("votes = 3")
        .select((F.col("missing") - 1).alias("low"), "missing", (F.col("missing") + 1).alias("high"))
    )


def expand_grid(spark: SparkSession, levels: dict[str, list]) -> DataFrame:
    """All combinations of short literal lists, first name varying slowest."""
    grid = spark.range(1).select()
    for name, values in levels.items():
        grid = grid.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return grid


def explode_grid(df: DataFrame, levels: dict[str, list]) -> DataFrame:
    """Each row once per combination of short literal lists."""
    for name, values in levels.items():
        df = df.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return df


def attach_by_id(rows: DataFrame, predictions: DataFrame, ident: str) -> DataFrame:
    """Put predictions beside their rows by id: rows have no position to zip by."""
    return rows.join(predictions, ident)


def explode_points(df: DataFrame, points: list[dict]) -> DataFrame:
    """Each row once per stated point, its fields as columns.  Points are parameters, not data: no join and no shuffle."""
    listed = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in p.items()]) for p in points])
    return df.withColumn("_point", F.explode(listed)).select("*", "_point.*").drop("_point")
