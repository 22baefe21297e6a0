"""Splits and grids on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.operators import joins, resample

_DRAW = "substr(md5('{seed}:' || {key}), 1, 8)"


@query("split_kfold", f"""
SELECT o_orderkey, (row_number() OVER (ORDER BY {_DRAW.format(seed=3, key='o_orderkey')}, o_orderkey) - 1) % 5 AS fold
FROM orders
""")
def split_kfold(t):
    return resample.kfold(t.orders.select("o_orderkey"), "o_orderkey", 5, seed=3)


@query("split_stratified_kfold", f"""
SELECT doc_id, quality, (row_number() OVER (PARTITION BY quality
  ORDER BY {_DRAW.format(seed=3, key='doc_id')}, doc_id) - 1) % 5 AS fold FROM labels
""")
def split_stratified_kfold(t):
    return resample.kfold(t.labels.select("doc_id", "quality"), "doc_id", 5, seed=3, strata=["quality"])


@query("split_holdout", f"""
SELECT o_orderkey, ('0x' || {_DRAW.format(seed=3, key='o_orderkey')})::BIGINT / 4294967296.0::DOUBLE < 0.75::DOUBLE AS is_train
FROM orders
""")
def split_holdout(t):
    return resample.holdout(t.orders.select("o_orderkey"), "o_orderkey", 0.75, seed=3)


@query("param_grid", """
SELECT q AS min_quantity, d AS max_discount, f AS flag,
       count(*) FILTER (l_quantity >= q AND l_discount <= d AND l_returnflag = f) AS n
FROM lineitem, (VALUES (10), (30)) a(q), (VALUES (0.02::DOUBLE), (0.05::DOUBLE), (0.08::DOUBLE)) b(d),
  (VALUES ('A'), ('R')) c(f) GROUP BY 1, 2, 3
""")
def param_grid(t):
    grid = {
        "min_quantity": resample.even_values(10, 30, 2, whole=True),
        "max_discount": [0.02, 0.05, 0.08], "flag": ["A", "R"],
    }
    # lines with the same measures are counted once before they meet the grid
    measures = t.lineitem.groupBy("l_quantity", "l_discount", "l_returnflag").agg(F.count("*").alias("lines"))
    hit = (
        (F.col("l_quantity") >= F.col("min_quantity")) & (F.col("l_discount") <= F.col("max_discount"))
        & (F.col("l_returnflag") == F.col("flag"))
    )
    return joins.explode_grid(measures, grid).groupBy(*grid).agg(
        F.sum(F.when(hit, F.col("lines")).otherwise(0)).alias("n")
    )


@query("param_picked_grid", """
WITH u AS (SELECT d.d, n.n AS name, i.i, row_number() OVER (PARTITION BY d.d, n.n ORDER BY md5('5:' || d.d || ':' || n.n || ':' || i.i)) - 1 AS s
  FROM range(20) d(d), (VALUES ('min_quantity'), ('max_discount'), ('max_tax')) n(n), range(25) i(i)),
c AS (SELECT d, i, max(s) FILTER (name = 'min_quantity') AS a, max(s) FILTER (name = 'max_discount') AS b,
  max(s) FILTER (name = 'max_tax') AS c FROM u GROUP BY 1, 2),
m AS (SELECT x.d, min((x.a - y.a) ** 2 + (x.b - y.b) ** 2 + (x.c - y.c) ** 2) AS gap
  FROM c x JOIN c y ON x.d = y.d AND x.i < y.i GROUP BY 1),
g AS (SELECT i AS point, floor(1 + (a + 0.5::DOUBLE) / 25 * 49 + 0.5::DOUBLE)::INT AS q,
  (b + 0.5::DOUBLE) / 25 * 0.1::DOUBLE AS d, (c + 0.5::DOUBLE) / 25 * 0.08::DOUBLE AS t
  FROM c WHERE d = (SELECT d FROM m ORDER BY gap DESC, d LIMIT 1)),
l AS (SELECT l_quantity AS q, l_discount AS d, l_tax AS t, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)
SELECT point, g.q AS min_quantity, round(g.d, 9) AS max_discount, round(g.t, 9) AS max_tax,
  coalesce(sum(l.n) FILTER (l.q >= g.q AND l.d <= g.d AND l.t <= g.t), 0)::BIGINT AS n FROM g, l GROUP BY 1, 2, 3, 4
""")
def param_picked_grid(t):
    """25 points that fill the space of three limits, and the lines that each lets through."""
    ranges = {"min_quantity": (1, 50), "max_discount": (0.0, 0.1), "max_tax": (0.0, 0.08)}
    picked = [{"point": i, **p} for i, p in enumerate(resample.spread_points(ranges, 25, designs=20, seed=5))]
    measures = t.lineitem.groupBy("l_quantity", "l_discount", "l_tax").agg(F.count("*").alias("lines"))
    hit = (
        (F.col("l_quantity") >= F.col("min_quantity")) & (F.col("l_discount") <= F.col("max_discount"))
        & (F.col("l_tax") <= F.col("max_tax"))
    )
    scored = joins.explode_points(measures, picked).groupBy("point", *ranges).agg(
        F.sum(F.when(hit, F.col("lines")).otherwise(0)).alias("n"))
    return scored.select(F.col("point").cast("bigint").alias("point"), "min_quantity",
                         *[F.round(c, 9).alias(c) for c in ("max_discount", "max_tax")], "n")
