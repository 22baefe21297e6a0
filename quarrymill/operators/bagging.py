"""Bags of trees: every tree has its own weighted rows and its own share of the features.

A row's weight in a tree is a Poisson draw from a hash of the row's key and the tree, which is what drawing rows with
replacement comes to when rows are many; nothing is copied and a fit repeats on any partitioning.  Rows of one tree that
agree in their bins and target are one row with their summed weights, before the shuffle already, where there are few kinds.  All
trees grow together, level by level.  A level is one aggregate: weights and weighted targets
summed per (tree, node, feature, bin), combined before the shuffle, so what is shuffled depends on trees,
nodes and bins and not on rows.  The best split of each node, a bounded table, goes to the driver; rows never do.

A target is a list of numbers: one per class for classes, the value itself for regression.  A split's worth is how far it
raises the sum of ``(weighted sum of a target) ** 2 / weight``: that is Gini's measure for classes and the
reduction of the squared error for values, so one machine serves both.

Defined results: rows without a label are left out, no labelled row is an error; a missing feature lies
below all values; equally good splits are decided by the first feature, then the lowest bin; equal votes
by the smallest class; a tree whose draw is empty has no vote.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.operators.boosting import alike, bin_limits, binned
from quarrymill.session import written


@dataclass(frozen=True)
class Bag:
    """``rows`` is the mean weight of a row in a tree, ``columns`` the share of the features that a tree sees,
    ``least_weight`` what each side of a split must hold."""

    trees: int = 20
    depth: int = 5
    rows: float = 1.0
    columns: float = 1.0
    least_weight: float = 1.0
    bins: int = 64
    seed: int = 17


@dataclass
class Bagged:
    """All trees in one list each: node ``i`` of tree ``t`` is at ``t * size + i`` and has the children
    ``2 i + 1`` and ``2 i + 2``; a leaf has feature -1.  ``value`` has ``targets`` numbers a node."""

    settings: Bag
    limits: list[list[float]]
    targets: int
    columns: list[list[int]]
    feature: list[int]
    cut: list[int]
    value: list[float]
    voters: int = 0

    @property
    def size(self) -> int:
        return 2 ** (self.settings.depth + 1) - 1


def _numbers(values, kind: str) -> Column:
    """A list as one literal, however long: Spark folds the split and the cast away."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _poisson_limits(rate: float) -> list[float]:
    """The draw is how many of these shares lie at or below a number in [0, 1)."""
    limits, term, total, n = [], math.exp(-rate), 0.0, 0
    while True:
        total += term
        if total >= 1 - 2 ** -30 or n > 20 * rate + 40:
            return limits
        limits.append(total)
        n += 1
        term *= rate / n


def _bins(features: list[str], limits: list[list[float]]) -> Column:
    return F.array(*[F.when(F.col(f).isNull(), -1).otherwise(binned(F.col(f), c)) for f, c in zip(features, limits)])


def weight(row: Column, tree: Column, settings: Bag) -> Column:
    """A row's weight in a tree."""
    unit = F.pmod(F.xxhash64(F.lit(settings.seed), tree, row), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return sum((F.lit(x) <= unit).cast("int") for x in _poisson_limits(settings.rows))


def weights(row: Column, settings: Bag) -> Column:
    """A row's weight in every tree."""
    return F.transform(F.sequence(F.lit(0), F.lit(settings.trees - 1)), lambda tree: weight(row, tree, settings))


def _node(model: Bagged, tree: Column, bins: Column, depth: int) -> Column:
    """Where a row ends in a tree after ``depth`` steps."""
    features, cuts = _numbers(model.feature, "int"), _numbers(model.cut, "int")

    def step(node: Column, _: Column) -> Column:
        place = tree * model.size + node
        at = F.get(features, place)
        right = F.get(bins, at) > F.get(cuts, place)
        return F.when(at < 0, node).otherwise(2 * node + 1 + right.cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)


def _nodes(model: Bagged, bins: Column, depth: int) -> Column:
    """Where a row ends in every tree after ``depth`` steps; ``bins`` is a variable there, else it could run again at each step."""
    trees = F.sequence(F.lit(0), F.lit(model.settings.trees - 1))
    found = F.transform(F.array(bins), lambda b: F.transform(trees, lambda tree: _node(model, tree, b, depth)))
    return F.get(found, F.lit(0))


def _level(model: Bagged, rows: DataFrame, level: int) -> int:
    """Split the nodes of one level; how many were split."""
    s, ks = model.settings, range(model.targets)
    keep = len(model.columns[0])
    chosen = _numbers([f for columns in model.columns for f in columns], "int")
    each = rows.withColumn("at", _node(model, F.col("tree"), F.col("bins"), level)).where(F.col("at") >= 2 ** level - 1)
    seen = F.transform(F.slice(chosen, F.col("tree") * keep + 1, F.lit(keep)),
                       lambda f: F.struct(f.alias("feature"), F.get("bins", f).alias("bin")))
    laid = each.select("tree", F.col("at").alias("node"), F.col("w").cast("double").alias("w"), "targets",
                       F.explode(seen).alias("seen")).select("tree", "node", "w", "targets", "seen.*")
    table = laid.groupBy("tree", "node", "feature", "bin").agg(
        F.sum("w").alias("w"), *[F.sum(F.col("w") * F.get("targets", F.lit(k))).alias(f"s{k}") for k in ks])
    whole = Window.partitionBy("tree", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    names = ["w", *[f"s{k}" for k in ks]]
    sums = table.select("tree", "node", "feature", "bin", *[F.sum(n).over(upto).alias(f"l_{n}") for n in names],
                        *[F.sum(n).over(whole).alias(n) for n in names])

    def worth(part) -> Column:
        return sum((part(f"s{k}") * part(f"s{k}") for k in ks), F.lit(0.0)) / part("w")

    left, right = (lambda n: F.col(f"l_{n}")), (lambda n: F.col(n) - F.col(f"l_{n}"))
    fit = (left("w") >= s.least_weight) & (right("w") >= s.least_weight)
    gain = F.when(fit, F.round(worth(left) + worth(right) - worth(F.col), 9)).otherwise(F.lit(-1.0))
    best = sums.withColumn("gain", gain).groupBy("tree", "node").agg(F.max_by(
        F.struct("feature", "bin", "gain", *names, *[f"l_{n}" for n in names]),
        F.struct(F.col("gain"), -F.col("feature"), -F.col("bin"))).alias("b"))

    def leaf(tree: int, node: int, weight: float, totals: list[float]) -> None:
        start = (tree * model.size + node) * model.targets
        model.value[start:start + model.targets] = [x / weight for x in totals]

    split = 0
    for row in best.collect():  # at most trees x nodes of a level
        tree, node, b = row["tree"], row["node"], row["b"]
        totals, lefts = [b[f"s{k}"] for k in ks], [b[f"l_s{k}"] for k in ks]
        if level == 0:
            model.voters += 1
            leaf(tree, node, b["w"], totals)
        if b["gain"] <= 0:
            continue
        split += 1
        model.feature[tree * model.size + node] = b["feature"]
        model.cut[tree * model.size + node] = b["bin"]
        leaf(tree, 2 * node + 1, b["l_w"], lefts)
        leaf(tree, 2 * node + 2, b["w"] - b["l_w"], [a - c for a, c in zip(totals, lefts)])
    return split


def fit_bag(df: DataFrame, ident: str, features: list[str], label: str, classes: int | None,
            settings: Bag = Bag()) -> Bagged:
    """Fit on labels ``0 .. classes - 1``, or on values where ``classes`` is ``None``."""
    rows = df.where(F.col(label).isNotNull())
    limits = bin_limits(rows, features, settings.bins)
    draw = random.Random(settings.seed)
    keep = max(1, round(settings.columns * len(features)))
    columns = [sorted(draw.sample(range(len(features)), keep)) for _ in range(settings.trees)]
    targets = classes or 1
    size = settings.trees * (2 ** (settings.depth + 1) - 1)
    model = Bagged(settings, limits, targets, columns, [-1] * size, [0] * size, [0.0] * size * targets)
    y = F.col(label).cast("double")
    wanted = F.array(y) if classes is None else F.array(*[(y == k).cast("double") for k in range(classes)])
    binned_rows = written(rows.select(
        F.col(ident).alias("row"), wanted.alias("targets"), _bins(features, limits).alias("bins")), "bagged-bins")
    drawn = binned_rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(settings.trees - 1)))).withColumn(
        "w", weight(F.col("row"), F.col("tree"), settings)).where("w > 0")
    rows = drawn
    if alike(binned_rows, "bins", "targets"):
        rows = written(drawn.groupBy("tree", "bins", "targets").agg(F.sum("w").alias("w")), "bagged-rows")
    for level in range(settings.depth):
        if not _level(model, rows, level):
            break
    if not model.voters:
        raise ValueError("no tree has a labelled row")
    return model


def _votes(model: Bagged, df: DataFrame, features: list[str]) -> tuple[DataFrame, Column]:
    """``df`` with the leaves of a row, and the mean of their targets."""
    made = df.withColumn("_bins", _bins(features, model.limits))
    made = made.withColumn("_leaves", _nodes(model, F.col("_bins"), model.settings.depth))
    values = _numbers(model.value, "double")

    def mean(k: int) -> Column:
        found = F.transform("_leaves", lambda leaf, tree: F.get(values, (tree * model.size + leaf) * model.targets + k))
        return F.aggregate(found, F.lit(0.0), lambda a, x: a + x) / model.voters

    return made, F.array(*[mean(k) for k in range(model.targets)])


def predict_bag(model: Bagged, df: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with ``probability`` (one per class) and ``prediction``; of a bag on values only the latter."""
    made, votes = _votes(model, df, features)
    if model.targets == 1:
        return made.withColumn("prediction", F.get(votes, F.lit(0))).drop("_bins", "_leaves")
    made = made.withColumn("probability", votes).drop("_bins", "_leaves")
    first = F.array_position("probability", F.array_max("probability")) - 1
    return made.withColumn("prediction", first.cast("int"))
