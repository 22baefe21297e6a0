"""Column selection, renaming, row filters and per-column checks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_range(df: DataFrame, first: str | int, last: str | int) -> DataFrame:
    """Columns from ``first`` to ``last`` inclusive, by name or position."""
    at = lambda x: x if isinstance(x, int) else df.columns.index(x)
    return df.select(*df.columns[at(first): at(last) + 1])


def rename_by_pattern(df: DataFrame, pattern: str, replacement: str = "") -> DataFrame:
    """Replace the first match of ``pattern`` in every column name."""
    return df.toDF(*[re.sub(pattern, replacement, c, count=1) for c in df.columns])


def move_columns(
    df: DataFrame, names: Iterable[str], after: str | None = None, before: str | None = None
) -> DataFrame:
    """Relocate ``names``: to the front, or right after / before a column."""
    names = list(names)
    rest = [c for c in df.columns if c not in names]
    at = rest.index(after) + 1 if after else rest.index(before) if before else 0
    return df.select(*rest[:at], *names, *rest[at:])


def typed_columns(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    """Names of the columns whose type is one of ``kinds``."""
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return typed_columns(df, T.NumericType)


def text_columns(df: DataFrame) -> list[str]:
    return typed_columns(df, T.StringType)


def map_columns(
    df: DataFrame, fn: Callable[[Column], Column], names: Iterable[str] | None = None
) -> DataFrame:
    """Apply ``fn`` to the named columns (all by default) in one projection."""
    chosen = set(df.columns if names is None else names)
    return df.select(*[fn(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])


def cast_columns(df: DataFrame, kinds: dict[str, str], strict: bool = False) -> DataFrame:
    """Convert the listed columns; text that does not parse becomes null unless strict."""
    convert = (lambda c, k: c.cast(k)) if strict else (lambda c, k: c.try_cast(k))
    return df.withColumns({c: convert(F.col(c), k) for c, k in kinds.items() if c in df.columns})


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the table's row count."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    report = df.sparkSession.createDataFrame(
        rows, "position INT, column STRING, type STRING, nullable BOOLEAN"
    )
    return report.withColumn("n_rows", df.select(F.count("*").alias("n")).scalar())


def null_counts(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """``(column, num_missing, n_rows)`` for every column from one pass over the table."""
    names = list(df.columns if names is None else names)
    one = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in names], F.count("*").alias("n_rows")
    )
    return one.unpivot(["n_rows"], names, "column", "num_missing")


def require_no_nulls(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The same rows; the job fails on the first null met in ``names``."""
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
            F.raise_error(F.lit(f"missing value in {c}")).cast(df.schema[c].dataType)
        )
        for c in names
    })


def stack_views(views: dict[str, DataFrame]) -> DataFrame:
    """All prepared results in one table with a ``view`` column."""
    stacked = None
    for label, df in views.items():
        one = df.withColumn("view", F.lit(label))
        stacked = one if stacked is None else stacked.unionByName(one, allowMissingColumns=True)
    return stacked
