"""Running totals, numbering, runs, look-backs: order-dependent work.

All of it goes through the chunked scans, so neither a table without keys nor
one dominant key ends up in a single task.  ``order`` must be a total order and
``position`` a number that does not decrease along it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.plans import chunked
from quarrymill.session import written


def running_ratio(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], win: Column, position: str | Column,
    name: str = "ratio",
) -> DataFrame:
    """Wins so far over losses so far; null while there are no losses.

    Whatever is not a win, a null included, counts as a loss.
    """
    won = F.coalesce(win, F.lit(False)).cast("bigint")
    sums = chunked.running(df, keys, order, {"wins": won, "losses": 1 - won}, position)
    return sums.withColumn(name, F.try_divide("wins", "losses"))


def current_ratio(df: DataFrame, keys: Sequence[str], win: Column, position: str, name: str = "ratio") -> DataFrame:
    """Each key's last row of :func:`running_ratio`, by one aggregate and without any ordering."""
    won = F.coalesce(win, F.lit(False))
    state = df.groupBy(*keys).agg(
        F.max(position).alias(position), F.count_if(won).alias("wins"), F.count_if(~won).alias("losses"))
    return state.withColumn(name, F.try_divide("wins", "losses"))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, position: str | Column,
    name: str = "total",
) -> DataFrame:
    """Running total where a null adds nothing and repeats the total before it (zero at first)."""
    return chunked.running(df, keys, order, {name: F.col(value)}, position)


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str, position: str | Column
) -> DataFrame:
    return chunked.row_numbers(df, keys, order, name, position)


GROUP_LIMIT = 1000  # Spark's own bound for limiting groups before the shuffle


def prefix(df: DataFrame, keys, order, n: int, position, name: str = "seq") -> DataFrame:
    """The first ``n`` rows of each key with their number.

    For a short prefix Spark keeps only ``n`` rows per key in each task before
    it shuffles, so a dominant key does no harm; longer ones are numbered in chunks.
    """
    if n > GROUP_LIMIT or not keys:
        return numbered(df, keys, order, name, position).where(F.col(name) <= n)
    first = Window.partitionBy(*keys).orderBy(*order)
    short = df.withColumn(name, F.row_number().over(first)).where(F.col(name) <= n)
    return short.withColumn(name, F.col(name).cast("bigint"))


def _local_runs(df, keys, order, value, position, rows_per_chunk):
    """Rows with ``_run``, the run number inside their ``(keys, chunk)``; and whether keys are cut."""
    rows, split = chunked.cut(df, keys, position, rows_per_chunk, chunked.nulls_last(order))
    part = [*keys, chunked.CHUNK]
    inner = Window.partitionBy(*part).orderBy(*order)
    # a chunk's first row starts a run; a null value is a value of its own
    starts = (F.row_number().over(inner) == 1) | ~F.col(value).eqNullSafe(F.lag(value).over(inner))
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    flagged = rows.withColumn("_starts", starts.cast("bigint"))
    return flagged.withColumn("_run", F.sum("_starts").over(upto)).drop("_starts"), part, split


def run_lengths(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                position: str | Column | None = None, rows_per_chunk: int = chunked.ROWS_PER_CHUNK) -> DataFrame:
    """Run-length encoding: ``(keys, run_id, value, len)`` with ``run_id`` 1, 2, ... per key.

    Runs are built inside the chunks, where grouping needs no further shuffle.
    Of a key that is cut, a chunk's summary (its number of runs, first and last
    value) tells the next chunk where its numbers begin and whether its first
    run goes on from before; pieces of one run then carry the same number and
    are added up.
    """
    local, part, split = _local_runs(df, keys, order, value, position, rows_per_chunk)
    # the value is fixed within a run; as a key it spares an aggregate over text
    pieces = local.groupBy(*part, "_run", value).agg(F.count("*").alias("len"))
    if not split:
        return pieces.select(*keys, F.col("_run").alias("run_id"), value, "len")
    cell = F.struct(F.col(value).alias("v"))
    ends = pieces.where(F.col(chunked.CHUNK) != chunked.WHOLE).groupBy(*part).agg(
        F.max("_run").alias("_runs"), F.min_by(cell, "_run").alias("_first"), F.max_by(cell, "_run").alias("_last")
    )
    # a run that goes on from the chunk before is counted once
    linked = chunked.last_before(ends, keys, "_before", "_last").withColumn(
        "_joined", F.coalesce(F.col("_first") == F.col("_before"), F.lit(False)).cast("bigint"))
    sums = chunked.sums_before(linked, keys, {"_runs_before": "_runs", "_joined_before": "_joined"})
    offsets = sums.select(*part, (F.col("_runs_before") - F.col("_joined_before") - F.col("_joined")).alias("_offset"))
    run_id = F.col("_run") + F.coalesce(F.col("_offset"), F.lit(0))
    return (
        chunked.attach(pieces, offsets, keys)
        .groupBy(*keys, run_id.alias("run_id"), value).agg(F.sum("len").alias("len"))
    )


def long_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, at_least: int,
              position: str | Column | None = None, name: str = "long_runs",
              rows_per_chunk: int = chunked.ROWS_PER_CHUNK) -> DataFrame:
    """Runs of at least the given length, per key (zero where there is none).

    Rows are shuffled once: a chunk counts the long runs that end and begin
    inside it and hands on only its first and last run, at most two rows per
    chunk, which are then joined up across the chunk borders.
    """
    local, part, split = _local_runs(df, keys, order, value, position, rows_per_chunk)
    pieces = local.groupBy(*part, "_run", F.col(value).alias("v")).agg(F.count("*").alias("len"))
    if not split:
        return pieces.groupBy(*keys).agg(F.count_if(F.col("len") >= at_least).alias(name))
    piece = F.struct("_run", "v", "len")
    chunks = pieces.groupBy(*part).agg(
        F.count_if(F.col("len") >= at_least).alias("_long"),
        F.min_by(piece, "_run").alias("_first"), F.max_by(piece, "_run").alias("_last"),
    )
    first, last = F.col("_first"), F.col("_last")
    borders = F.when(first["_run"] == last["_run"], F.array(first)).otherwise(F.array(first, last))
    is_long = lambda p: (p["len"] >= at_least).cast("bigint")
    inside = F.col("_long") - F.aggregate(borders, F.lit(0).cast("bigint"), lambda a, p: a + is_long(p))
    along = Window.partitionBy(*keys).orderBy(chunked.CHUNK, "_place")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    pieces_left = chunks.select(*part, inside.alias("_inside"), F.posexplode(borders).alias("_place", "_piece"))
    # the second border run of a chunk never continues the first
    continues = (F.col("_place") == 0) & F.struct("_piece.v").eqNullSafe(F.struct(F.lag("_piece.v").over(along)))
    continues = continues & F.lag(F.lit(True)).over(along).isNotNull()
    joined = (
        pieces_left.withColumn("_new", (~continues).cast("bigint"))
        .withColumn("_id", F.sum("_new").over(upto))
        .groupBy(*keys, "_id").agg(
            F.sum("_piece.len").alias("_len"),
            F.sum(F.when(F.col("_place") == 0, F.col("_inside")).otherwise(0)).alias("_inside"),
        )
    )
    return joined.groupBy(*keys).agg(
        (F.sum("_inside") + F.count_if(F.col("_len") >= at_least)).alias(name)
    )


def contiguous_sum(df: DataFrame, order: str, value: str, target: int) -> DataFrame:
    """First slice of two or more rows in ``order`` that adds up to ``target``.

    Values must be positive whole numbers.  With prefix sums ``P`` a slice is a
    pair ``P_j = P_i + target``: one equi-join.  The slice's bounds are two
    numbers, so its rows are then a plain range filter.
    """
    if not df.where(F.col(value) <= 0).isEmpty():
        raise ValueError(f"{value} must be positive")
    sums = written(chunked.running(
        df.select(order, value), [], [order],
        {"idx": F.lit(1).cast("bigint"), "upto": F.col(value)}, position=order,
    ), "prefix-sums")  # read three times
    ends = sums.select(F.col("idx").alias("j"), F.col("upto").alias("_p"))
    begins = sums.select(
        (F.col("idx") - 1).alias("i"), (F.col("upto") - F.col(value) + target).alias("_p")
    )
    first = (
        begins.join(ends, "_p").where("j - i >= 2")
        .agg(F.min(F.struct("i", "j")).alias("s"))
    ).first().s
    low, high = (first.i, first.j) if first is not None else (0, 0)
    inside = sums.where(F.col("idx").between(low + 1, high))
    return inside.agg(
        F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"),
        F.min(value).alias("low"), F.max(value).alias("high"), F.sum(value).alias("total"),
    ).withColumn("low_plus_high", F.col("low") + F.col("high"))


def first_failure(df: DataFrame, order: str, passed: Column, columns: Sequence[str]) -> DataFrame:
    """The first row in ``order`` that does not pass: one aggregate, no sort."""
    row = F.struct(*[F.col(c) for c in columns])
    return (
        df.where(~passed).agg(F.min_by(row, order).alias("_row"))
        .select(*[F.col(f"_row.{c}").alias(c) for c in columns])
    )


def successive_differences(df: DataFrame, value: str) -> DataFrame:
    """Distinct values with the difference to the one before (null on the first)."""
    distinct = chunked.with_chunks(df.select(value).distinct(), value, measure=df)
    return chunked.previous(distinct, [], [value], {"_before": value}).select(value, (F.col(value) - F.col("_before")).alias("difference"))
