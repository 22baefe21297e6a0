"""Walks over an edge table by jumps of doubling length.

``jumps`` holds the paths of exactly 1, 2, 4, ... edges, each made by joining the one before
with itself.  What is known within ``m`` edges, followed by all paths of ``m`` edges, is known within
``2 m``, so a walk of depth d needs log d rounds.  Where nodes have many ways in, long jumps may
outnumber the edges by far; then their length stays as it is and the walk goes on in strides of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.session import written

DENSE = 8  # times as many jumps as edges are too many to double again
FEW = 100_000  # jumps that are never too many


def _kept(df: DataFrame) -> tuple[DataFrame, int]:
    """A round's rows as a table in the shared folder, and their number from its footers.

    The files' size lets the planner broadcast a small round and leave the
    edges where they are; a large one is joined by a shuffle.
    """
    table = written(df, "round")
    return table, table.count()


def _summed(value: Column) -> Column:
    """A sum that is null where it, or any part of it, does not fit."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.try_sum(value))


def _then(left: DataFrame, jumps: DataFrame, keys: list[str], weighted: bool) -> DataFrame:
    """``keys, node[, mult]`` one jump further on; ways that meet are one row."""
    met = left.join(jumps, "node")
    node = F.col("_next").alias("node")
    if weighted:
        return met.groupBy(*keys, node).agg(_summed(F.try_multiply("mult", "_qty")).alias("mult"))
    return met.select(*keys, node).distinct()


class _Jumps:
    """The edges as ``node, _next[, _qty]``, and their doublings."""

    def __init__(self, edges: DataFrame, weighted: bool):
        self.weighted, self.length = weighted, 1
        rows = edges.where("node is not null and _next is not null")
        if weighted:  # parallel edges add up
            rows = rows.groupBy("node", "_next").agg(_summed(F.col("_qty")).alias("_qty"))
        else:
            rows = rows.select("node", "_next").distinct()
        self.table, self.edges = _kept(rows)
        self.rows = self.edges

    def double(self) -> bool:
        """Twice the length, unless there are too many jumps as it is."""
        if self.rows > max(FEW, DENSE * self.edges):
            return False
        left = self.table.withColumnsRenamed({"node": "_from", "_next": "node", "_qty": "mult"})
        longer = _then(left, self.table, ["_from"], self.weighted)
        renamed = longer.withColumnsRenamed({"node": "_next", "mult": "_qty"}).withColumnRenamed("_from", "node")
        self.table, self.rows = _kept(renamed)
        self.length *= 2
        return True


def _edges(df: DataFrame, source: str, target: str, *more: Column) -> DataFrame:
    return df.select(F.col(source).alias("node"), F.col(target).alias("_next"), *more)


def _spread(jumps: _Jumps, start: DataFrame, keys: list[str]) -> DataFrame:
    """Every ``keys, node`` met by one edge or more from ``start``.

    A round that meets nothing new ends the walk, so a cycle does too: distances have no gaps.
    """
    found, rows = _kept(_then(start, jumps.table, keys, False))
    last, rounds = found, 0
    while rows:
        step, rows = _kept(_then(last, jumps.table, keys, False).join(found, [*keys, "node"], "left_anti"))
        if not rows:
            break
        found, rounds = found.union(step), rounds + 1
        if rounds % 8 == 0:  # else the anti join would read ever more tables
            found = written(found, "found")
        # jumps as long as all that is known go from all of it, shorter ones from what came last
        last = found if jumps.double() else step
    return found


def reach(edges: DataFrame, start: DataFrame, source: str, target: str) -> DataFrame:
    """Every node met by following edges from ``start`` (one column ``node``)."""
    return _spread(_Jumps(_edges(edges, source, target), False), start.select("node").distinct(), [])


def closure(edges: DataFrame, source: str, target: str) -> DataFrame:
    """All ``(ancestor, descendant)`` pairs, each once."""
    jumps = _Jumps(_edges(edges, source, target), False)
    start = jumps.table.select(F.col("node").alias("ancestor"), "node").distinct()
    return _spread(jumps, start, ["ancestor"]).select("ancestor", F.col("node").alias("descendant"))


def weighted_reach(
    edges: DataFrame, start: DataFrame, source: str, target: str, qty: str,
) -> DataFrame:
    """Multiplicity of every node below the roots: ``(root, node, mult)``.

    ``start`` holds ``(root, node, mult)``.  Ways to a node are added up, so no round has more
    rows than roots have nodes.  Where a path is longer than there are nodes it runs through a cycle, which is
    an error; so is a multiplicity beyond 64 bits in edges without one.
    """
    jumps = _Jumps(_edges(edges, source, target, F.col(qty).cast("bigint").alias("_qty")), True)
    nodes = jumps.table.select("node").union(jumps.table.select("_next")).distinct().count()
    below, rows = _kept(_then(start.select("root", "node", "mult"), jumps.table, ["root"], True))
    last, known, rounds = below, 1, 0  # ``below`` holds all paths of up to ``known`` edges
    while rows:
        step, rows = _kept(_then(last, jumps.table, ["root"], True))
        if not rows:
            break
        if known >= nodes:
            raise ValueError("the edges hold a cycle")
        below, rounds = below.union(step), rounds + 1
        if rounds % 8 == 0:
            below = written(below, "found")
        known += jumps.length
        last = below if jumps.double() else step
    total = below.groupBy("root", "node").agg(_summed(F.col("mult")).alias("mult"))
    return total.withColumn("mult", F.coalesce("mult", F.raise_error(F.lit("a multiplicity is beyond 64 bits")).cast("bigint")))
