"""Projections, renames, filters and predicates on the shared tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.operators import joins, models, project, topk


@query("select_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def select_columns(t):
    return t.customer.select("c_custkey", "c_name", "c_mktsegment")


@query("select_range", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_range(t):
    return project.select_range(t.lineitem, 4, "l_tax")


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def drop_columns(t):
    return t.orders.drop("o_orderpriority", "o_orderstatus")


@query("rename_columns", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
       c_mktsegment AS segment FROM customer
""")
def rename_columns(t):
    return t.customer.withColumnsRenamed({
        "c_custkey": "id", "c_name": "name", "c_nationkey": "nation",
        "c_acctbal": "balance", "c_mktsegment": "segment",
    })


@query("rename_by_pattern", """
SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey,
       l_linenumber AS linenumber, l_quantity AS quantity, l_extendedprice AS extendedprice,
       l_discount AS discount, l_tax AS tax, l_returnflag AS returnflag,
       l_linestatus AS linestatus, l_shipdate AS shipdate FROM lineitem
""")
def rename_by_pattern(t):
    return project.rename_by_pattern(t.lineitem, "^l_")


@query("reorder_columns", """
SELECT p_brand, p_partkey, p_name, p_type, p_size, p_retailprice FROM part
""")
def reorder_columns(t):
    return project.move_columns(t.part, ["p_brand"])


@query("derive_row_total", """
SELECT l_orderkey, l_linenumber, l_partkey,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS total FROM lineitem
""")
def derive_row_total(t):
    total = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(total, 6).alias("total"))


@query("apply_all_columns", """
SELECT l_quantity / 255 AS l_quantity, l_extendedprice / 255 AS l_extendedprice,
       l_discount / 255 AS l_discount, l_tax / 255 AS l_tax FROM lineitem
""")
def apply_all_columns(t):
    measures = project.select_range(t.lineitem, "l_quantity", "l_tax")
    return project.map_columns(measures, lambda c: c / 255)


@query("select_by_dtype", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_by_dtype(t):
    return t.orders.select(*project.numeric_columns(t.orders))


@query("schema_report", """
WITH n AS (SELECT count(*) AS n_rows FROM lineitem)
SELECT v.*, n_rows FROM (VALUES (0, 'l_orderkey', 'bigint', true), (1, 'l_partkey', 'bigint', true),
  (2, 'l_suppkey', 'bigint', true), (3, 'l_linenumber', 'int', true), (4, 'l_quantity', 'double', true),
  (5, 'l_extendedprice', 'double', true), (6, 'l_discount', 'double', true), (7, 'l_tax', 'double', true),
  (8, 'l_returnflag', 'string', true), (9, 'l_linestatus', 'string', true),
  (10, 'l_shipdate', 'timestamp_ntz', true)) v(position, "column", type, nullable), n
""")
def schema_report(t):
    return project.schema_report(t.lineitem)


@query("filter_compare", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
WHERE l_quantity > 25 AND l_returnflag <> 'N'
""")
def filter_compare(t):
    return t.lineitem.where((F.col("l_quantity") > 25) & (F.col("l_returnflag") != "N")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )


@query("filter_in_list", """
SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal <= 5000
""")
def filter_in_list(t):
    return t.customer.where(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_acctbal") <= 5000)
    ).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("filter_equals_distinct", """
SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderstatus = 'F'
""")
def filter_equals_distinct(t):
    return t.orders.where(F.col("o_orderstatus") == "F").select("o_orderpriority").distinct()


@query("filter_complete_cases", """
SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem
WHERE l_discount <> 0 AND l_tax <> 0
""")
def filter_complete_cases(t):
    gaps = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )
    return gaps.na.drop("any")


@query("parameterised_view", """
WITH made AS (SELECT * FROM part WHERE p_size >= 25),
a AS (SELECT * FROM (SELECT *, rank() OVER (ORDER BY p_retailprice DESC) AS r FROM part) WHERE r <= 30),
b AS (SELECT p.* FROM part p JOIN (SELECT p_brand, max(p_size) AS m FROM part GROUP BY 1) g
      ON p.p_brand = g.p_brand AND p.p_size = g.m),
c AS (SELECT * FROM (SELECT *, rank() OVER (ORDER BY p_retailprice DESC) AS r FROM made) WHERE r <= 30),
d AS (SELECT p.* FROM part p JOIN (SELECT p_brand, max(p_retailprice) AS m FROM made GROUP BY 1) g
      ON p.p_brand = g.p_brand AND p.p_retailprice = g.m)
SELECT 'most expensive' AS view, p_partkey, p_brand, p_size, p_retailprice FROM a
UNION ALL SELECT 'largest per brand', p_partkey, p_brand, p_size, p_retailprice FROM b
UNION ALL SELECT 'most expensive, large', p_partkey, p_brand, p_size, p_retailprice FROM c
UNION ALL SELECT 'dearest per brand, large', p_partkey, p_brand, p_size, p_retailprice FROM d
""")
def parameterised_view(t):
    part = t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice")
    large = part.where("p_size >= 25")
    return project.stack_views({
        "most expensive": topk.top_with_ties(part, "p_retailprice", 30),
        "largest per brand": joins.rows_at_group_max(part, ["p_brand"], "p_size"),
        "most expensive, large": topk.top_with_ties(large, "p_retailprice", 30),
        "dearest per brand, large": joins.rows_at_group_max(
            part, ["p_brand"], "p_retailprice", maxima_from=large
        ),
    })


@query("assert_non_null", """
SELECT 'l_orderkey' AS "column", count(*) FILTER (l_orderkey IS NULL) AS num_missing, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'l_quantity', count(*) FILTER (l_quantity IS NULL), count(*) FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax = 0), count(*) FROM lineitem
""")
def assert_non_null(t):
    gaps = t.lineitem.select("l_orderkey", "l_quantity", F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    sound = project.require_no_nulls(gaps, ["l_orderkey", "l_quantity"])
    return project.null_counts(sound)


@query("split_features_label", """
SELECT vec_id, label::BIGINT AS label, 64 AS width, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings
""")
def split_features_label(t):
    rows = models.embedding_rows(t.embeddings)
    values = vector_to_array("features")
    return rows.select(
        "vec_id", F.col("label").cast("bigint").alias("label"), F.size(values).alias("width"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 6).alias("total"),
    )


@query("cast_columns", """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, CAST(trunc(p_retailprice) AS BIGINT) AS p_retailprice
FROM part
""")
def cast_columns(t):
    return project.cast_columns(
        t.part.select("p_partkey", "p_size", "p_retailprice"),
        {"p_size": "string", "p_retailprice": "bigint", "absent": "int"},
    )


@query("pull_column", """
WITH top AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1),
chosen AS (SELECT user_id FROM (SELECT user_id, rank() OVER (ORDER BY n DESC) AS r FROM top) WHERE r <= 3)
SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT user_id FROM chosen)
""")
def pull_column(t):
    counts = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    chosen = topk.top_with_ties(counts, "n", 3).select("user_id")
    return t.events.join(chosen, "user_id", "left_semi").select("event_id", "user_id", "event_type")
