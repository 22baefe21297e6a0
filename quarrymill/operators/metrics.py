"""Classification and regression metrics as plain aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.operators import aggregates
from quarrymill.plans import chunked


def accuracy(truth: str, guess: str) -> Column:
    return F.avg((F.col(truth) == F.col(guess)).cast("double"))


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return aggregates.counts(df, truth, guess)


def class_scores(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall and F1 per class; null where a class is never guessed or never true.

    Each row votes once for its true and once for its guessed class, so the
    counts need one aggregation and no join.
    """
    votes = F.array(
        F.struct(F.col(truth).alias("class"), F.lit(1).alias("true"), F.lit(0).alias("guessed"),
                 (F.col(truth) == F.col(guess)).cast("int").alias("hit")),
        F.struct(F.col(guess).alias("class"), F.lit(0).alias("true"), F.lit(1).alias("guessed"),
                 F.lit(0).alias("hit")),
    )
    sums = df.select(F.explode(votes).alias("v")).groupBy("v.class").agg(
        *[F.sum(f"v.{c}").alias(c) for c in ("true", "guessed", "hit")]
    )
    p, r = F.try_divide("hit", "guessed"), F.try_divide("hit", "true")
    return sums.select(
        "class", p.alias("precision"), r.alias("recall"),
        F.try_divide(2 * p * r, p + r).alias("f1"),
    )


def macro_scores(scores: DataFrame) -> DataFrame:
    """Unweighted means over the classes; undefined classes are left out."""
    return scores.agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")])


def rmse(truth: str, guess: str) -> Column:
    miss = F.col(truth) - F.col(guess)
    return F.sqrt(F.avg(miss * miss))


def log_loss(p_true: Column, floor: float = 1e-15) -> Column:
    """Mean negative natural log of the probability given to the true class."""
    return -F.avg(F.ln(F.greatest(p_true, F.lit(floor))))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve of a 0/1 label, ties counted half: one row ``auc``.

    Rows shrink to counts per score; a running count of the negatives below each
    score then gives the pairs ranked the right way round.
    """
    scored = df.where(F.col(score).isNotNull())
    per_score = scored.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    cut = chunked.with_chunks(per_score, score, measure=scored)
    placed = chunked.running(cut, [], [score], {"upto": F.col("neg")})
    below = F.col("upto") - F.col("neg")
    right = F.col("pos") * (below.cast("double") + F.col("neg") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return placed.agg(F.try_divide(F.sum(right), pairs).alias("auc"))


def roc_auc_one_vs_rest(df: DataFrame, label: str, scores: dict) -> DataFrame:
    """``(class, auc)`` of each class against the others; ``scores`` maps a class to its score column.

    One pass: the class is a key of the counts per score and of the running count.
    """
    cells = F.array(*[
        F.struct(F.lit(c).alias("class"), (F.col(label) == F.lit(c)).alias("y"), F.col(s).cast("double").alias("score"))
        for c, s in scores.items()
    ])
    rows = df.select(F.explode(cells).alias("cell")).select("cell.*").where("score IS NOT NULL")
    per_score = rows.groupBy("class", "score").agg(
        F.count_if(F.col("y")).alias("pos"), F.count_if(~F.col("y")).alias("neg"))
    placed = chunked.running(per_score, ["class"], ["score"], {"upto": F.col("neg")}, "score")
    below = F.col("upto") - F.col("neg")
    right = F.col("pos") * (below.cast("double") + F.col("neg") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return placed.groupBy("class").agg(F.try_divide(F.sum(right), pairs).alias("auc"))


def roc_auc_pairs(df: DataFrame, label: str, scores: dict) -> DataFrame:
    """``(class, against, auc)`` for every ordered pair of classes, ties counted half.

    ``scores`` maps a class to its score column.  The area is the chance that the class's own score
    ranks one of its rows above a row of the other class; it is null where either class has no row.
    Rows without a score in the class's column are left out there; labels that ``scores`` lacks are in no pair.

    One pass: rows shrink to counts of each class per (class, score), running counts of all classes
    follow, and k sums per class are what is left.
    """
    classes = list(scores)
    sides = F.array(*[
        F.struct(F.lit(i).alias("side"), F.col(s).cast("double").alias("score")) for i, s in enumerate(scores.values())
    ])
    rows = df.select(F.col(label).alias("_label"), F.explode(sides).alias("_cell")).select("_label", "_cell.*")
    n = [f"n{i}" for i in range(len(classes))]
    per_score = rows.where("score IS NOT NULL").groupBy("side", "score").agg(
        *[F.count_if(F.col("_label") == F.lit(c)).alias(name) for c, name in zip(classes, n)])
    placed = chunked.running(per_score, ["side"], ["score"], {f"u{name}": F.col(name) for name in n}, "score")
    own = F.get(F.array(*n), F.col("side")).cast("double")
    sums = placed.groupBy("side").agg(
        F.array(*[F.sum(own * (F.col(f"u{name}") - F.col(name) / 2)) for name in n]).alias("right"),
        F.array(*[F.sum(name).cast("double") for name in n]).alias("rows"))
    named = F.array(*[F.lit(c) for c in classes])
    pairs = sums.select("side", "right", "rows", F.explode(F.sequence(F.lit(0), F.lit(len(classes) - 1))).alias("other"))
    return pairs.where("side <> other").select(
        F.get(named, F.col("side")).alias("class"), F.get(named, F.col("other")).alias("against"),
        F.try_divide(F.get("right", F.col("other")), F.get("rows", F.col("side")) * F.get("rows", F.col("other"))).alias("auc"))


def roc_auc_hand_till(pairs: DataFrame) -> DataFrame:
    """One row ``auc``: the mean over all pairs of classes of the two areas between them.

    ``pairs`` is the result of :func:`roc_auc_pairs`; pairs without rows are left out.
    """
    return pairs.agg(F.avg("auc").alias("auc"))


def top_class_rates(df: DataFrame, label: str, tops: Sequence[int] = (1, 2)) -> DataFrame:
    """Share of rows in the commonest class, the two commonest, and so on."""
    best = aggregates.shares(df, label).orderBy(F.desc("n"), label).limit(max(tops))
    placed = best.withColumn("_place", F.row_number().over(Window.orderBy(F.desc("n"), label)))  # max(tops) rows
    counted = F.filter(F.array(*[F.lit(k) for k in tops]), lambda k: k >= F.col("_place"))
    return placed.select(F.explode(counted).alias("classes"), "prop").groupBy("classes").agg(F.sum("prop").alias("rate"))
