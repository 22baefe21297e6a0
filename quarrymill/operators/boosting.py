"""Boosted trees for many classes, by second-order gradients on binned features.

Rows keep their features as bin numbers and one raw score per class.  In every round each class
gets a tree; all of them grow level by level together.  A level is one aggregate: gradients
and hessians summed per (class, node, feature, bin), combined before the shuffle, so
what is shuffled depends on bins and not on rows.  Cumulated over the bins they give the gain
of every split, and the best split of each node, a bounded table, goes to the driver.  Rows never do; their new
scores are written once per round.  Where rows are of few kinds, those that agree in label and bins are one row from the start,
with the number of them that each round draws.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.session import written


@dataclass(frozen=True)
class Settings:
    """``rate`` shrinks every leaf, ``penalty`` is added to hessians, ``least_gain`` is what a split must exceed,
    ``least_weight`` the hessian each side must have; ``rows`` and ``columns`` are the shares drawn per round and per tree."""

    rounds: int = 20
    depth: int = 3
    rate: float = 0.3
    penalty: float = 1.0
    least_gain: float = 0.0
    least_weight: float = 1e-3
    rows: float = 1.0
    columns: float = 1.0
    bins: int = 64
    seed: int = 17


@dataclass
class Tree:
    """A heap: node ``i`` has the children ``2 i + 1`` and ``2 i + 2``; a leaf has feature -1."""

    feature: list[int]
    cut: list[int]
    value: list[float]


@dataclass
class Boosted:
    classes: int
    cuts: list[list[float]]
    settings: Settings
    trees: list[list[Tree]] = field(default_factory=list)  # per round, one per class


def bin_limits(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Upper limits of each feature's bins: at most ``bins - 1`` distinct quantiles, in one aggregate.

    A value held by at least one row in ``bins`` is always a limit.
    """
    shares = [(i + 1) / bins for i in range(bins - 1)]
    found = df.agg(*[F.percentile_approx(f, shares, 10_000).alias(f"f{i}") for i, f in enumerate(features)]).first()
    return [sorted({float(x) for x in found[f"f{i}"] or []}) for i in range(len(features))]


def binned(value: Column, limits: list[float]) -> Column:
    """How many limits lie below the value; a missing value is in the first bin."""
    if not limits:
        return F.lit(0)
    listed = F.array(*[F.lit(x) for x in limits])
    return F.when(value.isNull(), 0).otherwise(F.size(F.filter(listed, lambda x: x < value.cast("double"))))


def alike(rows: DataFrame, *columns: str) -> bool:
    """Whether there are at least four times as many rows as kinds of them in ``columns``, by estimate."""
    n, kinds = rows.agg(F.count("*"), F.approx_count_distinct(F.xxhash64(*columns))).first()
    return n >= 4 * kinds


def _drawn(row: Column, s: Settings, number: int) -> Column:
    """Whether a round draws a row."""
    unit = F.pmod(F.xxhash64(F.lit(s.seed), F.lit(number), row), F.lit(1 << 30)) / float(1 << 30)
    return (unit < s.rows).cast("bigint") if s.rows < 1 else F.lit(1).cast("bigint")


def _leaf_of(tree: Tree, bins: Column, depth: int) -> Column:
    """The node where a row ends, by walking down ``depth`` levels."""
    features, cuts = (F.array(*[F.lit(int(x)) for x in xs]) for xs in (tree.feature, tree.cut))

    def step(node: Column, _: Column) -> Column:
        at = F.get(features, node)
        right = F.get(bins, at) > F.get(cuts, node)
        return F.when(at < 0, node).otherwise(2 * node + 1 + right.cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)


def _probabilities(scores: Column) -> Column:
    """Softmax, from the differences to the largest score."""
    raised = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    return F.transform(raised, lambda e: e / F.aggregate(raised, F.lit(0.0), lambda a, x: a + x))


def _grown(rows: DataFrame, classes: int, n_features: int, s: Settings, number: int) -> list[Tree]:
    """One tree per class on the rows' probabilities ``p``; a row counts ``times`` times."""
    size = 2 ** (s.depth + 1) - 1
    trees = [Tree([-1] * size, [0] * size, [0.0] * size) for _ in range(classes)]
    draw = random.Random(f"{s.seed}-{number}")
    keep = max(1, round(s.columns * n_features))
    columns = [sorted(draw.sample(range(n_features), keep)) for _ in range(classes)]
    allowed = F.array(*[F.array(*[F.lit(f in c) for f in range(n_features)]) for c in columns])
    rows = rows.where("times > 0")
    open_nodes = {(k, 0) for k in range(classes)}
    for level in range(s.depth):
        at = F.array(*[_leaf_of(t, F.col("bins"), level) for t in trees])
        each = rows.select("bins", "label", "times", F.posexplode(F.arrays_zip(F.col("p"), at.alias("at"))).alias("class", "one"))
        hessian = F.col("one.p") * (1 - F.col("one.p")) * F.col("times")
        gradient = (F.col("one.p") - (F.col("label") == F.col("class")).cast("double")) * F.col("times")
        laid = each.where(F.col("one.at") >= 2 ** level - 1).select(
            "class", F.col("one.at").alias("node"), gradient.alias("g"), hessian.alias("h"), F.posexplode("bins").alias("feature", "bin"))
        laid = laid.where(F.get(F.get(allowed, F.col("class")), F.col("feature")))
        table = laid.groupBy("class", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        whole = Window.partitionBy("class", "node", "feature")
        upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        sums = table.select("class", "node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
                            F.sum("g").over(whole).alias("g"), F.sum("h").over(whole).alias("h"))
        worth = lambda g, h: g * g / (h + s.penalty)
        gr, hr = F.col("g") - F.col("gl"), F.col("h") - F.col("hl")
        gain = (worth(F.col("gl"), F.col("hl")) + worth(gr, hr) - worth(F.col("g"), F.col("h"))) / 2 - s.least_gain
        fit = (F.col("hl") >= s.least_weight) & (hr >= s.least_weight)
        rated = sums.withColumn("gain", F.when(fit, F.round(gain, 9)).otherwise(F.lit(-1.0)))
        best = rated.groupBy("class", "node").agg(F.max_by(
            F.struct("feature", "bin", "gl", "hl", "g", "h", "gain"),
            F.struct(F.col("gain"), -F.col("feature"), -F.col("bin"))).alias("b"))
        leaf = lambda g, h: -s.rate * g / (h + s.penalty)
        following = set()
        for row in best.collect():  # at most classes x nodes of a level
            k, node, b = row["class"], row["node"], row["b"]
            if (k, node) not in open_nodes:
                continue
            trees[k].value[node] = leaf(b["g"], b["h"])
            if b["gain"] > 0:
                trees[k].feature[node], trees[k].cut[node] = b["feature"], b["bin"]
                left, right = 2 * node + 1, 2 * node + 2
                trees[k].value[left] = leaf(b["gl"], b["hl"])
                trees[k].value[right] = leaf(b["g"] - b["gl"], b["h"] - b["hl"])
                following |= {(k, left), (k, right)}
        open_nodes = following
        if not open_nodes:
            break
    return trees


def _raised(scores: Column, bins: Column, trees: list[Tree], depth: int) -> Column:
    return F.array(*[
        F.get(scores, F.lit(k)) + F.get(F.array(*[F.lit(float(v)) for v in t.value]), _leaf_of(t, bins, depth))
        for k, t in enumerate(trees)])


def fit_boosted_classes(df: DataFrame, ident: str, features: list[str], label: str, classes: int,
                        settings: Settings = Settings()) -> Boosted:
    """Fit on whole-number labels ``0 .. classes - 1``; rows without a label are left out.

    The draws of rows and columns are hashes of ``ident`` and the round, so a fit repeats on any partitioning.
    """
    cuts = bin_limits(df, features, settings.bins)
    model = Boosted(classes, cuts, settings)
    rows = df.where(F.col(label).isNotNull()).select(
        F.col(ident).alias("row"), F.col(label).cast("int").alias("label"),
        F.array(*[binned(F.col(f), c) for f, c in zip(features, cuts)]).alias("bins"))
    rows = written(rows, "boosted-bins")
    times = lambda number: _drawn(F.col("row"), settings, number)
    if alike(rows, "label", "bins"):
        each = [F.sum(times(number)) for number in range(settings.rounds)]
        rows = rows.groupBy("label", "bins").agg(F.array(*each).alias("row"))
        times = lambda number: F.get("row", F.lit(number))
    rows = written(rows.withColumn("scores", F.array(*[F.lit(0.0)] * classes)), "boosted-rows")
    for number in range(settings.rounds):
        ready = rows.withColumns({"p": _probabilities(F.col("scores")), "times": times(number)})
        trees = _grown(ready, classes, len(features), settings, number)
        model.trees.append(trees)
        if number + 1 < settings.rounds:
            rows = written(rows.withColumn("scores", _raised(F.col("scores"), F.col("bins"), trees, settings.depth)), "boosted-rows")
    return model


def predict_boosted_classes(model: Boosted, df: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with ``probability`` (one per class, adding up to one) and ``prediction``."""
    made = df.withColumn("_bins", F.array(*[binned(F.col(f), c) for f, c in zip(features, model.cuts)]))
    def total(k: int) -> Column:
        parts = [F.get(F.array(*[F.lit(float(v)) for v in trees[k].value]), _leaf_of(trees[k], F.col("_bins"), model.settings.depth))
                 for trees in model.trees]
        return F.aggregate(F.array(*parts), F.lit(0.0), lambda a, x: a + x) if parts else F.lit(0.0)

    made = made.withColumn("_scores", F.array(*[total(k) for k in range(model.classes)]))
    made = made.withColumn("probability", _probabilities(F.col("_scores")))
    first = F.array_position("probability", F.array_max("probability")) - 1
    return made.withColumn("prediction", first.cast("int")).drop("_bins", "_scores")
