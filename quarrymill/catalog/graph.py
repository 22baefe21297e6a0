"""Graph work on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.operators import graph


def _part_tree(t):
    """Part k sits in part (k - 1) / 2, in a quantity set by its size."""
    return t.part.where("p_partkey > 0").select(
        F.floor((F.col("p_partkey") - 1) / 2).alias("parent"), F.col("p_partkey").alias("child"),
        (F.col("p_size") % 3 + 1).cast("bigint").alias("qty"),
    )


_TREE = """
WITH RECURSIVE e AS (SELECT (p_partkey - 1) // 2 AS parent, p_partkey AS child, (p_size % 3 + 1)::BIGINT AS qty
  FROM part WHERE p_partkey > 0),
"""


@query("graph_ancestors", _TREE + """
r AS (SELECT parent AS node FROM e JOIN part ON child = p_partkey WHERE p_size = 50
  UNION SELECT e.parent FROM e JOIN r ON e.child = r.node)
SELECT node FROM r
""")
def graph_ancestors(t):
    targets = t.part.where("p_size = 50").select(F.col("p_partkey").alias("node"))
    return graph.ancestors(_part_tree(t), targets)


@query("graph_weighted_descendants", _TREE + """
r AS (SELECT p_partkey AS root, p_partkey AS node, 1::BIGINT AS mult FROM part WHERE p_type = 'PROMO'
  UNION ALL SELECT r.root, e.child, r.mult * e.qty FROM r JOIN e ON e.parent = r.node)
SELECT root, sum(mult)::BIGINT AS total FROM r WHERE node <> root GROUP BY 1
""")
def graph_weighted_descendants(t):
    roots = t.part.where("p_type = 'PROMO'").select(F.col("p_partkey").alias("node"))
    return graph.items_below(_part_tree(t), roots)


@query("graph_closure_pairs", """
SELECT r_name AS ancestor, n_name AS descendant FROM region JOIN nation ON n_regionkey = r_regionkey
UNION ALL SELECT n_name, c_name FROM nation JOIN customer ON c_nationkey = n_nationkey
UNION ALL SELECT r_name, c_name FROM region JOIN nation ON n_regionkey = r_regionkey
  JOIN customer ON c_nationkey = n_nationkey
""")
def graph_closure_pairs(t):
    lands = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.col("r_name").alias("parent"), F.col("n_name").alias("child")
    )
    people = t.nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("n_name").alias("parent"), F.col("c_name").alias("child")
    )
    return graph.closure(lands.union(people))


@query("graph_inbound_lookup", """
WITH d AS (SELECT DISTINCT p_size * 2 + p_size % 3 AS v FROM part),
p AS (SELECT a.v, string_agg(b.v, ',' ORDER BY b.v) AS parents FROM d a JOIN d b ON a.v - b.v BETWEEN 1 AND 3 GROUP BY 1),
c AS (SELECT a.v, string_agg(b.v, ',' ORDER BY b.v) AS children FROM d a JOIN d b ON b.v - a.v BETWEEN 1 AND 3 GROUP BY 1)
SELECT d.v, coalesce(parents, '') AS parents, coalesce(children, '') AS children
FROM d LEFT JOIN p USING (v) LEFT JOIN c USING (v)
""")
def graph_inbound_lookup(t):
    values = t.part.select((F.col("p_size") * 2 + F.col("p_size") % 3).alias("v"))
    parents = graph.neighbours(values, "v", -3, -1, "parents")
    children = graph.neighbours(values, "v", 1, 3, "children")
    shown = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return parents.join(children, "v").select("v", shown("parents"), shown("children"))
