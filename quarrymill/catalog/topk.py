"""Sorts, limits, top-n and sampling on the shared tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.operators import topk
from quarrymill.plans import chunked


@query("sort_desc", """
SELECT s_suppkey, s_acctbal, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS place FROM supplier
""")
def sort_desc(t):
    rows = t.supplier.select("s_suppkey", "s_acctbal")
    place = chunked.tie_broken(rows, F.round(-100 * F.col("s_acctbal")), "s_suppkey")
    return chunked.row_numbers(rows, [], [F.desc("s_acctbal"), "s_suppkey"], "place", place).orderBy("place")


@query("sort_by_custom_order", """
WITH m(month, ordinal) AS (VALUES ('January', 1), ('February', 2), ('March', 3), ('April', 4),
  ('May', 5), ('June', 6), ('July', 7), ('August', 8), ('September', 9), ('October', 10),
  ('November', 11), ('December', 12)),
c AS (SELECT monthname(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1)
SELECT c.month, m.ordinal::BIGINT AS ordinal, c.n,
       rank() OVER (ORDER BY c.n DESC, m.ordinal) AS by_count FROM c JOIN m USING (month)
""")
def sort_by_custom_order(t):
    # fixed values: the month names in calendar order
    months = ["January", "February", "March", "April", "May", "June", "July", "August",
              "September", "October", "November", "December"]
    counts = t.orders.groupBy(F.date_format("o_orderdate", "MMMM").alias("month")).agg(F.count("*").alias("n"))
    placed = topk.by_custom_order(counts, "month", months)
    # twelve rows at most, so levels ordered by their counts may use one small window
    return placed.withColumn(
        "by_count", F.rank().over(Window.orderBy(F.desc("n"), "ordinal")).cast("bigint")
    ).orderBy("ordinal")


@query("topn_with_ties", """
SELECT p_partkey, p_retailprice FROM part QUALIFY rank() OVER (ORDER BY p_retailprice DESC) <= 31
""")
def topn_with_ties(t):
    return topk.top_with_ties(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", 31)


@query("nsmallest", """
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 10
""")
def nsmallest(t):
    return topk.first_n(t.part.select("p_partkey", "p_retailprice"), 10, "p_retailprice", "p_partkey")


@query("slice_max_last", """
WITH m AS (SELECT p_brand, round(avg(p_retailprice), 0) AS mean_price FROM part GROUP BY 1)
SELECT p_brand, mean_price FROM m ORDER BY mean_price DESC, p_brand DESC LIMIT 1
""")
def slice_max_last(t):
    means = t.part.groupBy("p_brand").agg(F.round(F.avg("p_retailprice"), 0).alias("mean_price"))
    return topk.last_of_best(means, "mean_price", "p_brand")


@query("head_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head_rows(t):
    return topk.first_n(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 5, "o_orderkey")


@query("sample_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 100
""")
def sample_n(t):
    return topk.sample_n(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 100, seed=7)


@query("shuffle_replicates", """
WITH r AS (SELECT rep, p_partkey, p_brand, substr(md5('7-' || rep || ':' || p_partkey), 1, 8) AS draw
  FROM part, range(1, 6) g(rep))
SELECT rep::INT AS rep, p_partkey, p_brand, row_number() OVER (PARTITION BY rep ORDER BY draw, p_partkey) AS place FROM r
""")
def shuffle_replicates(t):
    copies = topk.shuffled_replicates(t.part.select("p_partkey", "p_brand"), "p_partkey", 5, seed=7)
    return chunked.row_numbers(copies, ["rep"], ["_draw", "p_partkey"], "place").drop("_draw")
