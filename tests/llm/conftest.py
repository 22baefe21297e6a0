import pytest


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark, docs_schema):
    """Documents from (doc_id, text[, lang[, source]]) rows, in two partitions."""

    def make(rows, extra: dict | None = None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, docs_schema).repartition(2)
        for name, value in (extra or {}).items():
            df = df.withColumn(name, value)
        return df

    return make
