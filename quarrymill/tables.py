"""Lazy access to the shared Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrymill.session import apply_settings

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """``Tables(spark, folder).orders`` is a lazy scan of ``folder/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
