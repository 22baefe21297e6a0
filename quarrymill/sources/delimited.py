"""Delimited files: single files, folders, awkward headers, sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.session import scratch_path


_BLANKS_KEPT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_QUOTES = {"escape": '"'}  # a quote inside a text is doubled, as spreadsheets do


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, null_text: str | None = "NA",
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV with a stated schema: no inference pass over the data.

    Blanks around a text belong to it.  Only with ``multi_line`` may a quoted
    text hold line breaks; a file is then read by one task, so write many.
    """
    reader = spark.read.schema(schema).option("header", True).options(**_BLANKS_KEPT, **_QUOTES)
    if multi_line:
        reader = reader.option("multiLine", True).option("lineSep", "\n")
    if null_text is not None:
        reader = reader.option("nullValue", null_text)
    return reader.csv(path)


def read_csv_folder(
    spark: SparkSession, path: str, schema: T.StructType | str, suffix: str = ".txt",
    name_column: str = "file_stem", null_text: str | None = "NA", level: str = "file",
) -> DataFrame:
    """Every file below a folder in one scan, with its name (less ``suffix``) as a column.

    ``level="folder"`` takes the name of the file's own folder instead.  Spark
    reports names percent-encoded (a blank arrives as ``%20``), hence the decode.
    """
    files = (
        spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
        .options(**_BLANKS_KEPT, **_QUOTES).option("nullValue", null_text or "").csv(path)
    )
    if level == "folder":
        name = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1)
    else:
        name = F.col("_metadata.file_name")
    stem = F.regexp_replace(F.url_decode(name), re.escape(suffix) + "$", "")
    return files.select("*", stem.alias(name_column))


def positional_schema(header: list[str], types: dict[int, T.DataType] | None = None) -> T.StructType:
    """A schema for a header with blank and repeated names.

    A blank name becomes ``_c{i}`` and a repeated one gets its position added,
    so every field can be addressed; ``types`` maps positions to types.
    """
    types = types or {}
    counts = {h: header.count(h) for h in header}
    fields = []
    for i, h in enumerate(header):
        name = f"_c{i}" if h == "" else f"{h}{i}" if counts[h] > 1 else h
        fields.append(T.StructField(name, types.get(i, T.StringType())))
    return T.StructType(fields)


def read_ragged_header(
    spark: SparkSession, path: str, header: list[str], keep: list[int],
    types: dict[int, T.DataType] | None = None,
) -> DataFrame:
    """Columns picked by position from files whose header cannot name them.

    The header check is off because the file's own names are not unique.
    """
    schema = positional_schema(header, types)
    df = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", True)
        .options(**_BLANKS_KEPT, **_QUOTES).csv(path)
    )
    return df.select(*[F.col(f"`{schema[i].name}`") for i in keep])


def write_csv(df: DataFrame, path: str, null_text: str = "NA") -> str:
    df.write.mode("overwrite").option("header", True).option("nullValue", null_text).options(
        **_BLANKS_KEPT, **_QUOTES).csv(path)
    return path


def csv_round_trip(df: DataFrame, label: str, null_text: str = "NA") -> DataFrame:
    """Write to the shared folder and read back with the same schema.

    Tables with texts are read with line breaks allowed in them.
    """
    spark = df.sparkSession
    path = write_csv(df, scratch_path(spark, label), null_text)
    texts = any(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    return read_csv(spark, path, df.schema, null_text, multi_line=texts)


def store_table(df: DataFrame, label: str) -> DataFrame:
    """Keep a prepared table as Parquet under the shared folder and reload it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
