"""Every query with a DuckDB text against that text, and every other query runs."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, difference

SQL = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_equals_sql(name, spark, folder, duck):
    assert difference(QUERIES[name](spark, folder), duck, SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_rows_only(name, spark, folder):
    assert QUERIES[name](spark, folder).collect()


def test_entry(spark):
    got = entry(spark)
    assert set(got.columns) == {"user_id", "event_id", "wins", "losses", "ratio"}
    assert got.count() >= 3


def test_every_sql_text_has_a_query():
    assert set(SQL) <= set(QUERIES)
