"""CSV files without a stated schema: headers that differ and types found in the values."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.session import written
from quarrymill.sources.delimited import _BLANKS_KEPT, _QUOTES

# from narrow to wide; a value fits every type whose bit it sets, and a column the types all its values fit
TYPES = ("boolean", "bigint", "double", "date", "timestamp")
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?Inf(inity)?$|^NaN$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$"


def fitting_types(text: Column) -> Column:
    """Bits of the ``TYPES`` a text can be read as; 0 for other text, null for null.

    ``true`` and ``false`` count in any case.  Whole numbers beyond 64 bits are doubles, days are
    times too, and a day or time that does not exist is text.
    """
    day = text.rlike(_DAY) & text.try_cast("date").isNotNull()
    tests = (
        F.lower(text).isin("true", "false"),
        text.rlike(_WHOLE) & text.try_cast("bigint").isNotNull(),
        text.rlike(_NUMBER),
        day,
        day | (text.rlike(_TIME) & text.try_cast("timestamp").isNotNull()),
    )
    bits = [F.when(test, F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(tests)]
    return F.when(text.isNotNull(), reduce(lambda a, b: a.bitwiseOR(b), bits))


def narrowest(bits: int | None) -> str:
    """The narrowest type of a column's bits; text where there is none or no value."""
    return next((t for i, t in enumerate(TYPES) if (bits or 0) >> i & 1), "string")


def column_types(df: DataFrame) -> dict[str, str]:
    """The narrowest type that holds every value of each text column, by one aggregate over the rows."""
    if not df.columns:
        return {}
    found = df.agg(*[F.bit_and(fitting_types(F.col(f"`{c}`"))).alias(f"t{i}") for i, c in enumerate(df.columns)]).head()
    return {c: narrowest(found[i]) for i, c in enumerate(df.columns)}


def _named(header: Column) -> Column:
    """Blank names become ``_c{i}``; a repeated one gets its position added."""
    return F.transform(header, lambda h, i: F.when(F.coalesce(h, F.lit("")) == "", F.concat(F.lit("_c"), i)).when(
        F.size(F.filter(header, lambda x: x == h)) > 1, F.concat(h, i)).otherwise(h))


def headers(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """``(file, names)``: the column names of every file below ``path``.

    A file's header is its first line with any text.  The part that starts at byte 0 holds it, and
    ids grow along a part, so it is one partial aggregate and no file is opened on the driver.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), F.regexp_replace("value", r"^\x{FEFF}", "").alias("line"),
    )
    first = lines.where((F.col("start") == 0) & (F.trim("line") != "")).groupBy("file").agg(
        F.min_by("line", "place").alias("line"))
    width = first.agg(F.max(F.size(F.split("line", re.escape(delimiter), -1)))).head()[0] or 0
    if not width:
        return first.select("file", F.array().cast("array<string>").alias("names"))
    fields = F.from_csv(
        "line", F.lit(", ".join(f"c{i} STRING" for i in range(width))), {"sep": delimiter, **_QUOTES})
    size = F.size(F.split("line", re.escape(delimiter), -1))
    parsed = F.array(*[fields[f"c{i}"] for i in range(width)])
    # a delimiter inside quotes makes the split longer than the fields: trailing gaps are cut
    used = F.when(F.col("line").contains('"'), F.array_max(F.transform(
        parsed, lambda x, i: F.when(x.isNotNull(), i + 1).otherwise(F.lit(0))))).otherwise(size)
    return first.select("file", _named(F.slice(parsed, F.lit(1), used)).alias("names"))


def read_csv_by_name(
    spark: SparkSession, path: str, null_texts: Sequence[str] = ("NA",), delimiter: str = ",",
    types: dict[str, str] | None = None, file_column: str | None = None,
) -> DataFrame:
    """Every CSV file below ``path`` as one table, columns matched by name, types from the values.

    Files may differ in the order and the set of their columns: a column that a file lacks is null
    there.  A column's type is the narrowest of ``TYPES`` that holds all its values in all files
    (whole numbers in one file and decimals in another make doubles; anything mixed with text is text).
    Empty fields and ``null_texts`` are null and fit every type; a column without values is text.
    ``types`` states types (by name) that are not to be found; if it names all columns no pass is spent on it.
    Texts may hold delimiters and doubled quotes, no line breaks.  Files without a line give no row, a
    folder without any header an empty table without columns.  Repeated and blank names are made
    unique by position.

    One scan finds the headers (one row a file, written and joined back by file name), one the types, one reads.
    """
    known = written(headers(spark, path, delimiter), "csv-headers")
    names = [r[0] for r in known.select(F.posexplode("names").alias("place", "name")).groupBy("name").agg(
        F.min("place").alias("place")).orderBy("place", "name").select("name").collect()]
    if not names:
        return spark.createDataFrame([], "")
    if file_column in names:
        raise ValueError(f"a file has a column {file_column} of its own")
    width = known.agg(F.max(F.size("names"))).head()[0]
    rows = (
        spark.read.schema(", ".join(f"c{i} STRING" for i in range(width)))
        .option("header", True).option("enforceSchema", True).option("recursiveFileLookup", True)
        .option("sep", delimiter).options(**_BLANKS_KEPT, **_QUOTES).csv(path)
        .select(F.array(*[f"c{i}" for i in range(width)]).alias("fields"), F.col("_metadata.file_path").alias("file"))
    )
    placed = rows.join(known, "file")
    gone = [F.lit(x) for x in null_texts]
    # a name that a file lacks has position 0, so its field number is -1, which is null
    cell = lambda name: F.get("fields", (F.array_position("names", name) - 1).cast("int"))
    value = lambda name: F.when(~cell(name).isin(*gone), cell(name)) if gone else cell(name)
    # numbered until the end, as names may differ in case only
    texts = placed.select("file", *[value(name).alias(f"f{i}") for i, name in enumerate(names)])
    stated = {f"f{i}": types[name] for i, name in enumerate(names) if types and name in types}
    found = column_types(texts.drop("file", *stated))
    typed = {**found, **stated}
    file_name = [F.url_decode(F.element_at(F.split("file", "/"), -1)).alias(file_column)] if file_column else []
    return texts.select(*[F.col(f"f{i}").try_cast(typed[f"f{i}"]).alias(name) for i, name in enumerate(names)], *file_name)
