"""Feature preparation: fit on one table, apply to another.

A fit is a small frame, a short list of levels or an ML stage; applying it
never refits.  One-row fits are used as scalar subqueries, so no join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.hashing import hash_wide
from quarrymill.functions.recode import has_value
from quarrymill.operators import project
from quarrymill.plans import chunked, quantiles
from quarrymill.session import written

def levels(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a category with their codes 0, 1, ... in sorted order: ``(value, code)``.

    A table, not a list: a category may have any number of values.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    ranged = written(
        values.repartitionByRange("value").sortWithinPartitions("value").withColumn("_range", F.spark_partition_id()),
        "levels")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy("value")
    return ranged.withColumn("_no", F.row_number().over(inside)).join(offsets, "_range").select(
        "value", (F.col("_offset") + F.col("_no") - 1).alias("code"))


def sparse_one_hot(df: DataFrame, column: str, fitted: DataFrame, output: str) -> DataFrame:
    """A sparse 0/1 vector over all fitted levels, however many there are.

    A value outside the fitted levels, or none, is a vector of zeros.
    """
    width = fitted.agg(F.coalesce(F.max("code") + 1, F.lit(0)).cast("int")).first()[0]
    known = fitted.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    coded = df.join(known, F.col(column) == F.col("_value"), "left").drop("_value")
    # a code past the last stands for "no level", which dropLast turns into zeros
    coded = coded.withColumn("_code", F.coalesce("_code", F.lit(width)).cast("double"))
    codes = fitted.sparkSession.range(width, width + 1).select(F.col("id").cast("double").alias("_code"))
    encoder = OneHotEncoder(inputCol="_code", outputCol=output, dropLast=True)
    return encoder.fit(codes).transform(coded).drop("_code")


def impute_median(fit: DataFrame, apply: DataFrame, column: str) -> DataFrame:
    middle = quantiles.exact_median(fit, column)
    return apply.withColumn(column, F.coalesce(F.col(column), middle.scalar()))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """One row with the commonest value; the smallest of several."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), column).limit(1).select(column)
    )


def impute_mode(fit: DataFrame, apply: DataFrame, column: str) -> DataFrame:
    return apply.withColumn(column, F.coalesce(F.col(column), most_frequent(fit, column).scalar()))


def impute_random_draw(
    fit: DataFrame, apply: DataFrame, column: str, key: str, position: str, seed: int = 0
) -> DataFrame:
    """Missing values take the value of a random observed row of ``fit``.

    Observed rows are numbered, a missing row's hash picks a number, and the two
    meet by an equi-join.  Rows with a value skip the join, which would
    otherwise send all of them to one task under a null key.  With nothing observed
    they stay null.
    """
    observed = chunked.row_numbers(
        fit.where(F.col(column).isNotNull()).select(key, column), [], [key], "_no", position
    ).select("_no", F.col(column).alias("_drawn"))
    n = fit.agg(F.count(column)).scalar()
    missing = apply.where(F.col(column).isNull()).withColumn("_no", F.try_mod(hash_wide(key, seed), n) + 1)
    filled = missing.join(observed, "_no", "left").withColumn(column, F.col("_drawn"))
    return apply.where(F.col(column).isNotNull()).unionByName(filled.select(*apply.columns))


def standardize(fit: DataFrame, apply: DataFrame, columns: Sequence[str], ddof: int = 1) -> DataFrame:
    """``(x - mean) / sd`` with the fit table's figures; ``ddof`` 1 for sample sd, 0 for population."""
    sd = F.stddev_samp if ddof else F.stddev_pop
    stats = fit.agg(F.struct(*[
        F.struct(F.avg(c).alias("m"), sd(c).alias("s")).alias(c) for c in columns
    ]).alias("stats"))
    s = stats.scalar()
    return apply.withColumns({c: (F.col(c) - s[c]["m"]) / F.nullif(s[c]["s"], F.lit(0.0)) for c in columns})


def one_hot(
    df: DataFrame, column: str, fitted: Sequence, drop: str | None = "last", prefix: str = ""
) -> DataFrame:
    """0/1 columns for the fitted levels, without the last, the first or none of them.

    A value outside the fitted levels gets zeros everywhere.
    """
    kept = {"last": list(fitted)[:-1], "first": list(fitted)[1:], None: list(fitted)}[drop]
    flag = lambda v: F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("bigint")
    return df.withColumns({f"{prefix}{v}": flag(v) for v in kept})


def align_levels(df: DataFrame, column: str, fixed: Sequence[str], name: str) -> DataFrame:
    """Code of a value in a fixed level list, from 0; null for a value not listed."""
    place = F.array_position(F.array(*[F.lit(v) for v in fixed]), F.col(column))
    return df.withColumn(name, F.when(place > 0, place - 1))


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """Keep columns with more than one value (missing is a value).

    Least, greatest and null count of every column come from one pass; no
    distinct count is needed to see that there is only one value.
    """
    row = df.agg(
        F.count("*").alias("_rows"),
        *[F.struct(F.min(c).eqNullSafe(F.max(c)).alias("same"), F.count(c).alias("n")).alias(c)
          for c in df.columns],
    ).first()
    constant = lambda s: s["same"] and s["n"] in (0, row["_rows"])
    return df.select(*[c for c in df.columns if not constant(row[c])])


def drop_near_constant_columns(df: DataFrame, ratio: float = 95 / 5, unique_share: float = 0.1) -> DataFrame:
    """Drop columns whose commonest value dwarfs the second and that hold few values.

    Values are counted in long form; the two largest counts per column are taken
    with a group limit, which Spark applies before the shuffle.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).unpivot(
        [], df.columns, "column", "value"
    )
    counted = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    largest = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    top2 = (
        counted.withColumn("place", F.row_number().over(largest)).where("place <= 2")
        .groupBy("column").agg(F.max("n").alias("first"), F.min("n").alias("second"), F.count("*").alias("k"))
    )
    sizes = counted.groupBy("column").agg(F.count("*").alias("values"), F.sum("n").alias("rows"))
    bad = top2.join(sizes, "column").where(
        (F.col("k") == 1)
        | ((F.col("first") / F.col("second") > ratio) & (F.col("values") / F.col("rows") <= unique_share))
    )
    gone = {r[0] for r in bad.select("column").collect()}  # at most one row per column
    return df.select(*[c for c in df.columns if c not in gone])


def dichotomize(df: DataFrame, columns: Sequence[str], prefix: str = "has_") -> DataFrame:
    """Replace mostly-missing columns by presence flags."""
    return df.withColumns({f"{prefix}{c}": has_value(F.col(c)) for c in columns}).drop(*columns)


def standard_scaler_stages(columns: Sequence[str], output: str = "scaled") -> list:
    """ML stages: assemble the columns and scale them with the sample sd."""
    return [
        VectorAssembler(inputCols=list(columns), outputCol=f"{output}_raw", handleInvalid="keep"),
        StandardScaler(inputCol=f"{output}_raw", outputCol=output, withMean=True, withStd=True),
    ]


def column_transformer_stages(
    df: DataFrame, levels: dict[str, Sequence[str]], ids: Sequence[str] = (), output: str = "features"
) -> list:
    """ML stages chosen by type: numbers scaled, texts one-hot with other levels all zero.

    Every text column needs its stated levels: finding them here would bring an
    open list to the driver (``sparse_one_hot`` serves those).  Columns in ``ids`` play no
    part and stay in the table untouched.
    """
    used = df.drop(*ids)
    numbers, texts = project.numeric_columns(used), project.text_columns(used)
    stages, parts = [], []
    if numbers:
        stages += standard_scaler_stages(numbers, "numbers")
        parts.append("numbers")
    if texts:
        codes, flags = [f"{c}_code" for c in texts], [f"{c}_flags" for c in texts]
        stages += [
            *[StringIndexerModel.from_labels(list(levels[c]), inputCol=c, outputCol=k, handleInvalid="keep")
              for c, k in zip(texts, codes)],
            # "keep" gives unseen values the last code, which dropLast turns into zeros
            OneHotEncoder(inputCols=codes, outputCols=flags, dropLast=True),
        ]
        parts += flags
    return [*stages, VectorAssembler(inputCols=parts, outputCol=output)]


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Spread a vector over named columns."""
    values = vector_to_array(vector)
    return df.withColumns({n: values[i] for i, n in enumerate(names)})


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)
