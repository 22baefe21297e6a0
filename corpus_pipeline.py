"""From raw documents to padded batches: five operators, one after the other.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a frame that is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrymill.llm import language_id, line_dedup, mixing, packing, simhash
from quarrymill.llm.common import written
from quarrymill.tables import Tables

ORACLE_SQL = None  # compression, Newton steps and fingerprints have no SQL form


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told."""
    return language_id.accepted_only(docs, language_id.fit(docs))


def unshared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines of ten or more different texts out of the texts; no document goes."""
    return line_dedup.replace_text(docs, per_text=True)  # else a text with ten copies would lose all its lines


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.repeat_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document the mixture took."""
    return packing.pack(docs, keep=["doc_id", "source", "lang"])


STAGES = [
    ("language_id", told_language),
    ("line_dedup", unshared_lines),
    ("near_dedup", one_of_each),
    ("mixture", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
