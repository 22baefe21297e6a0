"""Folds, hold-outs and parameter grids, all repeatable by seed."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.hashing import hash_int, hash_unit
from quarrymill.plans import chunked


def kfold(df: DataFrame, key: str, k: int, seed: int = 0, strata: Sequence[str] = ()) -> DataFrame:
    """Add ``fold`` 0..k-1: shuffled, sizes within one of each other (per stratum if given).

    Without strata the hash that shuffles is uniform, so rows are numbered in
    equal hash ranges; with strata only those too large for one task are cut.
    """
    drawn = df.withColumn("_draw", hash_int(key, seed))
    if not strata:
        drawn = chunked.with_uniform_chunks(drawn, F.col("_draw") / F.lit(4294967296.0), df.count())
    numbered = chunked.row_numbers(drawn, strata, ["_draw", key], "_no", position="_draw")
    return numbered.withColumn("fold", (F.col("_no") - 1) % k).drop("_draw", "_no")


def holdout(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Add ``is_train``: true for about ``fraction`` of the rows.  No shuffle."""
    return df.withColumn("is_train", hash_unit(key, seed) < fraction)


def even_values(low: float, high: float, resolution: int, whole: bool = False) -> list:
    """Evenly spaced values of a range; whole ones are rounded and repeats dropped."""
    step = (high - low) / (resolution - 1) if resolution > 1 else 0.0
    values = [low + i * step for i in range(resolution)]
    if not whole:
        return values
    return sorted({int(v + 0.5) for v in values})


def spread_points(ranges: dict[str, tuple], points: int, designs: int = 20, seed: int = 0) -> list[dict]:
    """A picked grid: ``points`` combinations that fill the space of ``ranges`` (name: low, high).

    Latin hypercubes: in every dimension each of ``points`` equal strata has one combination, at its middle.  The
    orders of the strata are hashes; of ``designs`` such hypercubes the one whose closest two combinations are
    farthest apart is taken, the first of equal ones.  A whole-number range gives whole numbers, which may repeat.
    """
    def order(design: int, name: str) -> list[int]:
        drawn = sorted(range(points), key=lambda i: md5(f"{seed}:{design}:{name}:{i}".encode()).hexdigest())
        place = {i: p for p, i in enumerate(drawn)}
        return [place[i] for i in range(points)]

    def closest(columns: list[list[int]]) -> int:
        rows = list(zip(*columns))
        return min((sum((a - b) ** 2 for a, b in zip(x, y)) for i, x in enumerate(rows) for y in rows[:i]), default=0)

    made = [[order(d, name) for name in ranges] for d in range(designs)]
    best = max(made, key=closest)

    def value(low, high, stratum: int):
        at = low + (stratum + 0.5) / points * (high - low)
        return int(at + 0.5) if isinstance(low, int) and isinstance(high, int) else at

    return [{name: value(*ranges[name], column[i]) for name, column in zip(ranges, best)} for i in range(points)]
