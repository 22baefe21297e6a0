"""Joins on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.catalog.ordered import PAIR_CHECK, pair_checks
from quarrymill.operators import joins
from quarrymill.plans import bands


@query("join_inner", """
SELECT o_orderkey, o_totalprice, c_name, n_name
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def join_inner(t):
    who = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", "c_name", "n_name"
    )


@query("join_group_max_back", """
SELECT p_partkey, p_brand, p_retailprice FROM part
QUALIFY rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) = 1
""")
def join_group_max_back(t):
    return joins.rows_at_group_max(
        t.part.select("p_partkey", "p_brand", "p_retailprice"), ["p_brand"], "p_retailprice"
    )


@query("join_group_max_unfiltered", """
SELECT p.p_partkey, p.p_brand, p.p_size, p.p_retailprice FROM part p
JOIN (SELECT p_brand, max(p_retailprice) AS top FROM part WHERE p_size >= 25 GROUP BY 1) m
  ON p.p_brand = m.p_brand AND p.p_retailprice = m.top
""")
def join_group_max_unfiltered(t):
    part = t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return joins.rows_at_group_max(part, ["p_brand"], "p_retailprice", maxima_from=part.where("p_size >= 25"))


@query("join_last_state", """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def join_last_state(t):
    return joins.last_state(t.events, ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"])


@query("join_pair_sum", """
SELECT DISTINCT least(a.p_size, b.p_size) AS low, greatest(a.p_size, b.p_size) AS high,
       a.p_size::BIGINT * b.p_size AS product
FROM part a JOIN part b ON a.p_size + b.p_size = 60 AND a.p_partkey <> b.p_partkey
""")
def join_pair_sum(t):
    return joins.pair_sums(t.part, "p_size", 60)


@query("join_triple_sum", """
WITH k AS (SELECT p_size::BIGINT AS v, count(*) AS n FROM part GROUP BY 1)
SELECT a.v AS a, b.v AS b, c.v AS c, a.v * b.v * c.v AS product
FROM k a, k b, k c WHERE a.v <= b.v AND b.v <= c.v AND a.v + b.v + c.v = 60
  AND a.n >= 1 + (a.v = b.v)::INT + (a.v = b.v AND b.v = c.v)::INT AND b.n >= 1 + (b.v = c.v)::INT
""")
def join_triple_sum(t):
    return joins.triple_sums(t.part.select(F.col("p_size").cast("bigint").alias("v")), "v", 60)


@query("join_band", """
WITH d AS (SELECT DISTINCT p_size FROM part)
SELECT a.p_size AS v, b.p_size AS other, b.p_size - a.p_size AS step,
       CASE WHEN b.p_size > a.p_size THEN 'above' ELSE 'below' END AS side
FROM d a JOIN d b ON (b.p_size - a.p_size BETWEEN 1 AND 3) OR (a.p_size - b.p_size BETWEEN 1 AND 3)
""")
def join_band(t):
    values = t.part.select("p_size").distinct()
    left, right = values.withColumnRenamed("p_size", "v"), values.withColumnRenamed("p_size", "other")
    above = bands.band_join(left, right, "v", "other", 1, 3).withColumn("side", F.lit("above"))
    below = bands.band_join(left, right, "v", "other", -3, -1).withColumn("side", F.lit("below"))
    return above.union(below).select("v", "other", (F.col("other") - F.col("v")).alias("step"), "side")


@query("join_window_pairs", PAIR_CHECK + "SELECT event_id, v, valid FROM c")
def join_window_pairs(t):
    return pair_checks(t).select("event_id", "v", "valid")


@query("join_anti_gap", """
WITH d AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT a.k AS low, a.k + 1 AS missing, b.k AS high FROM d a JOIN d b ON b.k = a.k + 2
WHERE NOT EXISTS (SELECT 1 FROM d m WHERE m.k = a.k + 1)
""")
def join_anti_gap(t):
    return joins.single_gaps(t.lineitem, "l_orderkey")


@query("join_semi", """
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def join_semi(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(urgent, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("join_cross_grid", """
WITH n AS (SELECT n_regionkey AS region, c_mktsegment AS segment, count(*) AS n
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
g AS (SELECT region, segment FROM
  (VALUES (0), (1), (2), (3), (4), (5)) a(region),
  (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('GARDEN'), ('HOUSEHOLD'), ('MACHINERY')) b(segment))
SELECT region, segment, coalesce(n.n, 0) AS n FROM g FULL JOIN n USING (region, segment)
""")
def join_cross_grid(t):
    """Every cell of the stated levels, empty ones too, and pairs outside the levels as they come."""
    grid = joins.expand_grid(t.spark, {
        "region": [0, 1, 2, 3, 4, 5],
        "segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "GARDEN", "HOUSEHOLD", "MACHINERY"],
    })
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    found = placed.groupBy(F.col("n_regionkey").alias("region"), F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("n")
    )
    return grid.join(found, ["region", "segment"], "full").na.fill(0, ["n"])


@query("join_positional", """
SELECT vec_id, label::BIGINT AS label, (list_position(embedding, list_max(embedding)) - 1) % 10 AS predicted
FROM embeddings
""")
def join_positional(t):
    best = F.array_position("embedding", F.array_max("embedding")) - 1
    guesses = t.embeddings.select("vec_id", (best % 10).cast("int").alias("predicted"))
    return joins.attach_by_id(
        t.embeddings.select("vec_id", F.col("label").cast("bigint").alias("label")), guesses, "vec_id"
    )
