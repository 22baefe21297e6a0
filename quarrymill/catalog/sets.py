"""Set operations and reshaping on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.operators import project, sets


@query("union_all", """
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier
""")
def union_all(t):
    return sets.stack(
        t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                          F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")),
    )


@query("set_union", """
SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000
UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000
""")
def set_union(t):
    return (
        t.customer.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"))
        .union(t.supplier.where("s_acctbal > 9000").select("s_nationkey")).distinct()
    )


@query("set_intersect", """
SELECT c_nationkey AS nation FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT'
INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
""")
def set_intersect(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    buyers = t.customer.join(urgent, "c_custkey", "left_semi").select(F.col("c_nationkey").alias("nation"))
    return buyers.intersect(t.supplier.where("s_acctbal > 5000").select("s_nationkey"))


@query("set_except", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def set_except(t):
    return t.orders.select("o_orderkey").subtract(t.lineitem.select("l_orderkey"))


@query("dedupe_unordered_pairs", """
SELECT DISTINCT least(c_nationkey, s_nationkey) AS low, greatest(c_nationkey, s_nationkey) AS high
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
""")
def dedupe_unordered_pairs(t):
    # every trade between a buying and a selling nation, whichever side is which
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("l_orderkey"), "c_nationkey"
    )
    sellers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    trades = t.lineitem.select("l_orderkey", "l_suppkey").join(buyers, "l_orderkey").join(sellers, "l_suppkey")
    return sets.unordered_pairs(trades, "c_nationkey", "s_nationkey")


@query("melt_wide_to_long", """
WITH w AS (SELECT l_returnflag, sum(l_quantity) AS quantity, sum(l_discount) AS discount, sum(l_tax) AS tax,
  sum(l_quantity) + sum(l_discount) + sum(l_tax) AS total FROM lineitem GROUP BY 1)
SELECT l_returnflag, 'quantity' AS measure, round(quantity, 4) AS amount FROM w
UNION ALL SELECT l_returnflag, 'discount', round(discount, 4) FROM w
UNION ALL SELECT l_returnflag, 'tax', round(tax, 4) FROM w
UNION ALL SELECT l_returnflag, 'total', round(total, 4) FROM w
""")
def melt_wide_to_long(t):
    wide = t.lineitem.groupBy("l_returnflag").agg(
        F.sum("l_quantity").alias("quantity"), F.sum("l_discount").alias("discount"), F.sum("l_tax").alias("tax")
    ).withColumn("total", F.col("quantity") + F.col("discount") + F.col("tax"))
    measures = project.numeric_columns(wide)
    return sets.melt(wide, ["l_returnflag"], measures, "measure", "amount").withColumn(
        "amount", F.round("amount", 4)
    )


@query("explode_members", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1
""")
def explode_members(t):
    words = sets.members(t.part, [], F.split("p_name", " "), "word")
    return words.groupBy("word").agg(F.count("*").alias("n"))
