"""Ordered scans that never pull a large group into one task.

A window over ``partitionBy(key)`` sorts every row of one key in one task, and
one without keys sorts the whole table there.  Here large groups are cut into
*chunks*: ranges of a position column whose limits are drawn from the data, so
a chunk holds about ``rows_per_chunk`` rows.  Windows run inside
``(keys, chunk)``; what a chunk needs to know about the rows before it (a running
total, the last row) is one small aggregated row per chunk, joined back on the
columns the window is already partitioned by.

With keys, only those with more than ``rows_per_chunk`` rows are cut, each at points of
its own.  A count per key finds them first; where there are none, the plain
window is all that runs.  The number of chunks follows from the rows alone, and
so does the number of keys that are cut: neither has an upper limit.  Rows without
a position come where the order puts its nulls, so the answer is the same cut or uncut.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.session import written

CHUNK = "_chunk"
PART = "_part"  # keys and chunk as one value, in which nulls are equal: windows and the join of carried rows share it
ROWS_PER_CHUNK = 1_000_000
OVERSAMPLE = 32  # points drawn per chunk; every 32nd becomes a limit, which evens the chunks
GROUP = 4_096  # chunks whose carried totals are added up together
WHOLE = -2  # chunk number of a key that is not cut
NULLS_FIRST, NULLS_LAST = -1, (1 << 31) - 1  # chunk numbers of rows without a position


def tie_broken(df: DataFrame, primary: Column, secondary: str) -> Column:
    """A position for ordering by a whole-number ``primary``, then by ``secondary``.

    The secondary number becomes a fraction below one, so a primary value shared
    by very many rows can still be cut.  A missing secondary number, which an
    ascending sort puts first, counts as the least.
    """
    span = df.agg(F.struct(F.min(secondary).alias("low"), F.max(secondary).alias("high"))).scalar()
    share = (F.col(secondary) - span["low"]) / (span["high"] - span["low"] + 1)
    return primary + F.coalesce(share, F.lit(0.0))


def nulls_last(order: Sequence[str | Column]) -> bool:
    """Whether the first column of an order puts its nulls at the end."""
    if not order or isinstance(order[0], str):
        return False
    stated = re.findall(r"NULLS (FIRST|LAST)", str(order[0]))
    return bool(stated) and stated[-1] == "LAST"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _position(position: str | Column) -> Column:
    return (F.col(position) if isinstance(position, str) else position).cast("double")


def _drawn(rows_per_chunk: int, *identity: str | Column) -> tuple[Column, int]:
    """Which rows give a point, by a hash, and how many points make a chunk."""
    one_in = max(1, rows_per_chunk // OVERSAMPLE)
    pick = F.pmod(F.xxhash64(F.lit(41), *identity), F.lit(one_in)) == 0
    return pick, max(1, rows_per_chunk // one_in)


def _limits(points: Column, step: int) -> Column:
    """Every ``step``-th of the sorted points, each once."""
    ordered = F.sort_array(points)
    return F.array_distinct(F.filter(ordered, lambda _, i: (i + 1) % step == 0))


def _numbered(df: DataFrame, limits: str, pos: str, last: bool) -> DataFrame:
    """Add ``_chunk``: how many limits lie at or below the position, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])

    def search(found: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda low, s: F.when(
            F.get(found, low + s - 1) <= F.col(pos), low + s).otherwise(low))

    # a lambda variable holds the limits, so that they are not computed again at every step
    place = F.get(F.transform(F.array(limits), search), F.lit(0))
    none = F.lit(NULLS_LAST if last else NULLS_FIRST)
    return df.withColumn(CHUNK, F.when(F.col(pos).isNull(), none).otherwise(place))


def with_chunks(
    df: DataFrame,
    position: str | Column,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    min_chunks: int | None = None,
    measure: DataFrame | None = None,
    last: bool = False,
) -> DataFrame:
    """Add ``_chunk``: ranges of ``position`` over the whole table.

    ``position`` must be numeric and must not decrease along the scan order;
    rows with equal positions share a chunk, and rows without one come first, or
    at the end with ``last``.  The rows are counted; the limits are a scalar
    subquery over a hashed share of the positions, ``OVERSAMPLE`` per chunk.
    For aggregated rows, ``measure`` gives the raw table with the position to draw
    the limits from: a range holds no more distinct values than raw rows, and
    the aggregation is not run twice.
    """
    pos = _position(position)
    source = df if measure is None else measure
    fewest = min_chunks or 2 * _partitions(df)
    size = max(1, min(rows_per_chunk, -(-source.count() // fewest)))
    identity = [pos] if measure is not None else [pos, *_hashable(df)]
    pick, step = _drawn(size, *identity)
    points = source.where(pick & pos.isNotNull()).select(pos.alias("p"))
    gather = F.collect_list if measure is None else F.collect_set
    limits = points.agg(_limits(gather("p"), step).alias("limits")).scalar()
    placed = df.withColumns({"_limits": limits, "_position": pos})
    return _numbered(placed, "_limits", "_position", last).drop("_limits", "_position")


def _hashable(df: DataFrame) -> list[str]:
    """Columns that tell rows apart; maps and the like cannot be hashed."""
    return [f"`{name}`" for name, kind in df.dtypes if not kind.startswith(("map", "array", "struct", "variant"))]


def _null_safe(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs.items()])


def with_hot_chunks(
    df: DataFrame, keys: Sequence[str], position: str | Column, rows_per_chunk: int = ROWS_PER_CHUNK,
    last: bool = False,
) -> tuple[DataFrame, bool]:
    """Add ``_chunk`` for the keys too large for one task; say whether there are any.

    Such keys and their own limits are a table in the shared folder, joined to
    the rows by whatever means its size suggests to the planner.  A key without
    any position has no limits and cannot be cut.
    """
    named = {k: f"_hot_{k}" for k in keys}
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_chunk)
    hot = written(counts.select(*[F.col(k).alias(n) for k, n in named.items()]), "large-keys")
    if hot.isEmpty():
        return df.withColumn(CHUNK, F.lit(WHOLE)), False
    pos = _position(position)
    pick, step = _drawn(rows_per_chunk, pos, *_hashable(df))
    drawn = df.where(pick & pos.isNotNull()).select(*keys, pos.alias("_position"))
    points = drawn.join(hot, _null_safe(drawn, hot, named)).groupBy(*named.values()).agg(
        _limits(F.collect_list("_position"), step).alias("_limits"))
    limits = written(points, "key-limits")
    placed = df.withColumn("_position", pos)
    marked = placed.join(limits, _null_safe(placed, limits, named), "left").drop(*named.values())
    cut = _numbered(marked, "_limits", "_position", last)
    return cut.withColumn(
        CHUNK, F.when(F.col("_limits").isNotNull(), F.col(CHUNK)).otherwise(F.lit(WHOLE))
    ).drop("_limits", "_position"), True


def with_uniform_chunks(
    df: DataFrame, unit: Column, rows: int, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Add ``_chunk`` for a position known to be uniform on [0, 1), such as a hash.

    ``rows`` is how many rows share one scan; they give the number of chunks.  There are
    several per shuffle partition at least, which evens out how they fall on the tasks.
    """
    chunks = max(4 * _partitions(df), -(-rows // rows_per_chunk))
    return df.withColumn(CHUNK, F.floor(unit * F.lit(chunks)).cast("int"))


def cut(
    df: DataFrame, keys: Sequence[str], position: str | Column | None, rows_per_chunk: int = ROWS_PER_CHUNK,
    last: bool = False,
) -> tuple[DataFrame, bool]:
    """Rows with ``_chunk``, and whether any group spans several chunks."""
    if CHUNK in df.columns:
        return df, True
    if position is None:
        raise ValueError("give a position column or a frame with chunks")
    if keys:
        return with_hot_chunks(df, keys, position, rows_per_chunk, last)
    return with_chunks(df, position, rows_per_chunk, last=last), True


def attach(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the carried row of each ``(keys, chunk)`` to its rows; uncut keys have none.

    The strategy is left to the planner.  Rows that were windowed by ``_part`` are
    already partitioned and sorted for it.
    """
    part = F.struct(*keys, CHUNK)
    rest = [c for c in carry.columns if c not in (*keys, CHUNK)]
    known = carry.select(part.alias("_carry_part"), *rest)
    held = rows if PART in rows.columns else rows.withColumn(PART, part)
    return held.join(known, F.col(PART) == F.col("_carry_part"), "left").drop("_carry_part", PART)


def _grouped(chunks: DataFrame, keys: Sequence[str], over_group, over_chunk, joined) -> DataFrame:
    """Two levels of a scan over chunk summaries.

    Chunks are scanned inside groups of ``GROUP`` of them; the groups, a
    4096th as many, are scanned in turn and joined back.
    """
    level = chunks.withColumn("_group", F.floor(F.col(CHUNK) / GROUP))
    part = [*keys, "_group"]
    named = {c: f"_outer_{c}" for c in part}
    outer = over_group(level, part, Window.partitionBy(*keys).orderBy("_group")).withColumnsRenamed(named)
    inner = over_chunk(level, Window.partitionBy(*part).orderBy(CHUNK))
    both = inner.join(outer, _null_safe(inner, outer, named), "left")
    return joined(both).drop("_group", *named.values())


def sums_before(chunks: DataFrame, keys: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Running sums over the chunks before each one, zero at first.

    ``names`` maps an output name to the summed column of ``chunks``.
    """
    frame = (Window.unboundedPreceding, -1)

    def over_group(level, part, along):
        sums = level.groupBy(*part).agg(*[F.sum(c).alias(c) for c in names.values()])
        return sums.select(*part, *[F.sum(c).over(along.rowsBetween(*frame)).alias(f"_outer_{o}") for o, c in names.items()])

    def over_chunk(level, along):
        return level.withColumns({o: F.sum(c).over(along.rowsBetween(*frame)) for o, c in names.items()})

    def joined(both):
        return both.withColumns({
            o: F.coalesce(o, F.lit(0)) + F.coalesce(F.col(f"_outer_{o}"), F.lit(0)) for o in names
        }).drop(*[f"_outer_{o}" for o in names])

    return _grouped(chunks, keys, over_group, over_chunk, joined)


def last_before(chunks: DataFrame, keys: Sequence[str], name: str, column: str) -> DataFrame:
    """The column's value on the chunk before, null on the first."""

    def over_group(level, part, along):
        tails = level.groupBy(*part).agg(F.max_by(F.struct(column), CHUNK).alias("_tail_row"))
        return tails.select(*part, F.lag("_tail_row").over(along).alias("_outer_tail"))

    def over_chunk(level, along):
        return level.withColumn("_inner_tail", F.lag(F.struct(column)).over(along))

    def joined(both):
        value = F.coalesce("_inner_tail", "_outer_tail")[column]
        return both.withColumn(name, value).drop("_inner_tail", "_outer_tail")

    return _grouped(chunks, keys, over_group, over_chunk, joined)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    totals: dict[str, Column],
    position: str | Column | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Running sums per key in ``order``; nulls add nothing.

    ``totals`` maps an output name to the summed expression.  A running count
    is the sum of one, a row number the same.
    """
    rows, split = cut(df, keys, position, rows_per_chunk, nulls_last(order))
    part = [*keys, CHUNK]
    held = rows.withColumn(PART, F.struct(*part)) if split else rows
    along = Window.partitionBy(PART) if split else Window.partitionBy(*part)
    inner = along.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    local = held.withColumns({n: F.sum(F.coalesce(e, zero)).over(inner) for n, e in totals.items()})
    if not split:
        return local.drop(CHUNK)
    sums = rows.where(F.col(CHUNK) != WHOLE).groupBy(*part).agg(
        *[F.sum(F.coalesce(e, zero)).alias(f"_sum_{n}") for n, e in totals.items()]
    )
    carry = sums_before(sums, keys, {f"_before_{n}": f"_sum_{n}" for n in totals}).drop(
        *[f"_sum_{n}" for n in totals])
    return attach(local, carry, keys).withColumns(
        {n: F.col(n) + F.coalesce(F.col(f"_before_{n}"), zero) for n in totals}
    ).drop(CHUNK, *[f"_before_{n}" for n in totals])


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str,
    position: str | Column | None = None, rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Number rows 1, 2, ... per key in ``order`` (which must be total)."""
    return running(df, keys, order, {name: F.lit(1).cast("bigint")}, position, rows_per_chunk)


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    position: str | Column | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """The previous row's values per key in ascending ``order``; null on the first row.

    ``values`` maps an output name to the column it looks back at.
    """
    rows, split = cut(df, keys, position, rows_per_chunk)
    part = [*keys, CHUNK]
    if not split:
        inner = Window.partitionBy(*part).orderBy(*order)
        return rows.withColumns({n: F.lag(v).over(inner) for n, v in values.items()}).drop(CHUNK)
    inner = Window.partitionBy(PART).orderBy(*order)
    fields = F.struct(*[F.col(v).alias(n) for n, v in values.items()])
    lasts = rows.where(F.col(CHUNK) != WHOLE).groupBy(*part).agg(
        F.max_by(fields, F.struct(*order)).alias("_last")
    )
    carry = last_before(lasts, keys, "_tail", "_last").drop("_last")
    local = rows.withColumn(PART, F.struct(*part)).withColumns(
        {"_first": F.row_number().over(inner) == 1,
         **{f"_lag_{n}": F.lag(v).over(inner) for n, v in values.items()}}
    )
    return attach(local, carry, keys).withColumns(
        {n: F.when(F.col("_first"), F.col(f"_tail.{n}")).otherwise(F.col(f"_lag_{n}"))
         for n in values}
    ).drop(CHUNK, "_first", "_tail", *[f"_lag_{n}" for n in values])


def lookback(
    df: DataFrame,
    keys: Sequence[str],
    index: str,
    n: int,
    frames: dict[str, Callable],
    block: int = 65_536,
) -> DataFrame:
    """Window expressions over the ``n`` rows before each row.

    ``index`` is a gap-free number per key.  Rows are grouped in blocks of
    ``block`` indexes and each block borrows the last ``n`` rows of the one
    before it, so no task holds more than ``block + n`` rows of a key.
    ``frames`` maps an output name to a function of the window.
    """
    if n > block:
        raise ValueError("the block must be at least as long as the frame")
    home = F.floor(F.col(index) / block)
    tail = F.pmod(F.col(index), F.lit(block)) >= block - n
    spread = df.withColumn("_home", home).withColumn(
        "_block", F.explode(F.when(tail, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    frame = Window.partitionBy(*keys, "_block").orderBy(index).rowsBetween(-n, -1)
    return (
        spread.withColumns({name: make(frame) for name, make in frames.items()})
        .where(F.col("_home") == F.col("_block"))
        .drop("_home", "_block")
    )
