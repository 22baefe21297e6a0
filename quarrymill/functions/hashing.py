"""Repeatable "random" choices: the same key and seed always draw the same number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(key: str | Column, seed) -> Column:
    col = F.col(key) if isinstance(key, str) else key
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), col.cast("string")))


def hash_text(key: str | Column, seed=0) -> Column:
    """Hex digest of ``seed:key``; sorting by it is a shuffle."""
    return _text(key, seed)


def hash_int(key: str | Column, seed=0) -> Column:
    """Whole number in [0, 2^32) from the digest's first eight hex digits."""
    return F.conv(F.substring(_text(key, seed), 1, 8), 16, 10).cast("bigint")


def hash_wide(key: str | Column, seed=0) -> Column:
    """Whole number in [0, 2^60) from fifteen hex digits: enough to draw one of any number of rows."""
    return F.conv(F.substring(_text(key, seed), 1, 15), 16, 10).cast("bigint")


def hash_unit(key: str | Column, seed=0) -> Column:
    """Number in [0, 1); it grows with :func:`hash_text`."""
    return hash_int(key, seed) / F.lit(4294967296.0)
