"""Small tables stated in code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def literal_table(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A dict of equally long lists as a table, columns in the stated order."""
    return spark.createDataFrame(list(zip(*columns.values())), schema)
