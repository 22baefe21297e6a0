"""Model fitting, tuning and scoring with Spark ML.

Builders return unfitted estimators on ``features`` / ``label`` columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
    MultilayerPerceptronClassifier, NaiveBayes, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.util import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.operators import resample
from quarrymill.session import cut_lineage

SEED = 17
ROWS_PER_TASK = 100_000  # of a fit: a forest keeps each row with its weight in every tree
MOST_NUMBERS = 1 << 25  # of a discriminant model: 256 MB on the driver


def embedding_rows(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """An array column as the ``features`` vector, with a double ``label``."""
    return df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>"))).withColumn(
        "label", F.col("label").cast("double")
    ).drop(vector)


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in partitions of some ``ROWS_PER_TASK`` rows; a table of no more is left as it lies.

    The files decide on partitions by their bytes, and few columns of a large file are very many rows.
    """
    parts = -(-(df.count() if rows is None else rows) // ROWS_PER_TASK)
    return df.repartition(parts) if parts > 1 else df


# ---- estimators ------------------------------------------------------------

def decision_tree(regression: bool = False, depth: int = 5):
    return (DecisionTreeRegressor if regression else DecisionTreeClassifier)(maxDepth=depth, seed=SEED)


def random_forest(
    regression: bool = False, trees: int = 20, depth: int = 5, features: str = "auto", rows: float = 1.0
):
    """``features`` and ``rows`` are the shares tried per split and drawn per tree."""
    kind = RandomForestRegressor if regression else RandomForestClassifier
    return kind(numTrees=trees, maxDepth=depth, featureSubsetStrategy=features, subsamplingRate=rows, seed=SEED)


def bagging(regression: bool = False, trees: int = 20, depth: int = 5, rows: float = 0.8):
    """Bootstrap trees that all see every feature."""
    return random_forest(regression, trees, depth, "all", rows)


def boosted_trees(classes: int | None = 2, rounds: int = 20, depth: int = 3, rate: float = 0.1):
    """Gradient boosting: a regressor for ``classes=None``, one machine per class above two."""
    if classes is None:
        return GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED)
    binary = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED)
    return binary if classes == 2 else OneVsRest(classifier=binary, parallelism=4)


def logistic(reg: float = 0.01):
    return LogisticRegression(family="auto", regParam=reg, maxIter=50)


def linear_svm(classes: int = 2, reg: float = 0.01):
    machine = LinearSVC(regParam=reg, maxIter=20)
    return machine if classes == 2 else OneVsRest(classifier=machine, parallelism=4)


def naive_bayes():
    return NaiveBayes(modelType="gaussian")


def perceptron(layers: Sequence[int], rounds: int = 30):
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=rounds, seed=SEED)


def penalised_linear(reg: float, mix: float):
    """Elastic net: ``mix`` 0 is ridge, 1 is lasso."""
    return LinearRegression(regParam=reg, elasticNetParam=mix, maxIter=100)


def stacked_linear():
    """Dense layers without activation compose to one linear map, so this is plain least squares."""
    return LinearRegression(regParam=0.0, solver="l-bfgs", maxIter=200, tol=1e-12)


# ---- boosting of weak learners ---------------------------------------------

def fit_adaboost(df: DataFrame, classes: int, rounds: int = 5, depth: int = 1) -> list[tuple[float, object]]:
    """SAMME: weighted stumps, each round raising the weight of the rows it missed.

    Weights live in the table and every round is checkpointed, so the plan does
    not grow with the rounds.
    """
    rows = cut_lineage(spread(df.select("features", "label").withColumn("weight", F.lit(1.0))))
    learners = []
    for i in range(rounds):
        stump = DecisionTreeClassifier(maxDepth=depth, weightCol="weight", seed=SEED + i).fit(rows)
        scored = stump.transform(rows)
        miss = (F.col("prediction") != F.col("label")).cast("double")
        err = scored.agg(F.sum(F.col("weight") * miss) / F.sum("weight")).first()[0]
        if err >= 1 - 1 / classes:
            if not learners:
                raise ValueError("no tree of this depth is better than chance: take deeper ones")
            break
        alpha = math.log((1 - err) / max(err, 1e-12)) + math.log(classes - 1)
        learners.append((alpha, stump))
        if err <= 1e-12:
            break
        rows = cut_lineage(scored.select(
            "features", "label", (F.col("weight") * F.exp(F.lit(alpha) * miss)).alias("weight")
        ))
    return learners


def predict_adaboost(learners, df: DataFrame, classes: int) -> DataFrame:
    """Weighted vote; the smallest class wins a tie."""
    votes = [F.lit(0.0)] * classes
    out = df
    for i, (alpha, stump) in enumerate(learners):
        out = stump.transform(out).withColumnRenamed("prediction", f"_p{i}").drop("rawPrediction", "probability")
        votes = [v + F.when(F.col(f"_p{i}") == c, alpha).otherwise(0.0) for c, v in enumerate(votes)]
    best = F.array_position(F.array(*votes), F.array_max(F.array(*votes))) - 1
    return out.withColumn("prediction", best.cast("double")).drop(*[f"_p{i}" for i in range(len(learners))])


# ---- discriminants ---------------------------------------------------------

def class_moments(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``(label, dim, n, mean, variance)`` per class and dimension."""
    long = df.select(label, F.posexplode(F.col(vector).cast("array<double>")).alias("dim", "x"))
    return long.groupBy(label, "dim").agg(
        F.count("*").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("variance")
    )


def _class_sums(df: DataFrame, label: str, vector: str) -> dict:
    """Per class: row count, vector sum and sum of outer products.

    Each task reduces its rows to one record per class; those are added up by
    position, so the driver receives one model-sized record per class.
    """
    def partial(batches):
        sums = {}
        for pdf in batches:
            for cls, part in pdf.groupby("label"):
                x = np.stack(part["vec"].to_numpy()).astype("f8")
                new = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
                sums[cls] = sums.get(cls, 0.0) + new
        for cls, total in sums.items():
            yield pd.DataFrame({"label": [cls], "sums": [total.tolist()]})

    parts = df.select(F.col(label).cast("double").alias("label"), F.col(vector).alias("vec")).mapInPandas(
        partial, "label double, sums array<double>"
    )
    added = (
        parts.select("label", F.posexplode("sums").alias("i", "s")).groupBy("label", "i").agg(F.sum("s").alias("s"))
        .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("v"))
    )
    return {r["label"]: np.array([e["s"] for e in r["v"]]) for r in added.collect()}


def fit_discriminant(df: DataFrame, label: str, vector: str, quadratic: bool = False, ridge: float = 1e-6) -> dict:
    """Gaussian classes with a shared (linear) or an own (quadratic) covariance."""
    width, kinds = df.agg(F.max(F.size(vector)), F.count_distinct(label)).first()
    if width and kinds * width * width > MOST_NUMBERS:
        raise ValueError(f"a model of {kinds} classes in {width} dimensions does not fit the driver")
    sums = _class_sums(df, label, vector)
    labels = sorted(sums)
    d = int((math.isqrt(4 * len(sums[labels[0]]) - 3) - 1) // 2)
    counts = np.array([sums[c][0] for c in labels])
    means = np.array([sums[c][1: d + 1] / sums[c][0] for c in labels])
    scatter = [
        sums[c][d + 1:].reshape(d, d) - n * np.outer(m, m) for c, n, m in zip(labels, counts, means)
    ]
    total, shrink = counts.sum(), ridge * np.eye(d)
    if quadratic:
        covs = [s / max(n - 1, 1) + shrink for s, n in zip(scatter, counts)]
    else:
        covs = [sum(scatter) / (total - len(labels)) + shrink] * len(labels)
    return {"labels": np.array(labels), "means": means, "inverse": np.array([np.linalg.inv(c) for c in covs]),
            "logdet": np.array([np.linalg.slogdet(c)[1] for c in covs]), "prior": counts / total}


def predict_discriminant(model: dict, df: DataFrame, vector: str) -> DataFrame:
    @F.pandas_udf("double")
    def best(vec: pd.Series) -> pd.Series:
        x = np.stack(vec.to_numpy()).astype("f8")
        scores = []
        for m, inv, logdet, prior in zip(model["means"], model["inverse"], model["logdet"], model["prior"]):
            c = x - m
            scores.append(np.log(prior) - 0.5 * logdet - 0.5 * np.einsum("ij,jk,ik->i", c, inv, c))
        return pd.Series(model["labels"][np.argmax(np.array(scores), axis=0)])

    return df.withColumn("prediction", best(F.col(vector)))


# ---- evaluation, tuning, scoring -------------------------------------------

def evaluator(metric: str):
    """The evaluator that knows a metric: of regression, of two-class scores, else of classes."""
    if metric in ("rmse", "mse", "mae", "r2", "var"):
        return RegressionEvaluator(metricName=metric)
    if metric in ("areaUnderROC", "areaUnderPR"):
        return BinaryClassificationEvaluator(metricName=metric)
    return MulticlassClassificationEvaluator(metricName=metric)


def cross_validate(
    models: dict[str, Estimator], df: DataFrame, key: str, k: int, metric: str = "accuracy",
    strata: Sequence[str] = (), parallelism: int = 4,
) -> DataFrame:
    """``(model, fold, score)`` of each model on each held-out fold.

    The folds are computed once, written to the checkpoint folder and shared by
    all fits, so every fit reads stable rows.  Fits are independent jobs and run
    ``parallelism`` at a time, as the built-in cross validator does.
    """
    folds = cut_lineage(spread(resample.kfold(df, key, k, seed=SEED, strata=strata), df.count()))
    scorer = evaluator(metric)

    def score(task):
        name, fold = task
        fitted = models[name].fit(folds.where(F.col("fold") != fold))
        return name, fold, float(scorer.evaluate(fitted.transform(folds.where(F.col("fold") == fold))))

    with ThreadPool(parallelism) as pool:
        scores = pool.map(inheritable_thread_target(df.sparkSession)(score), [(m, f) for m in models for f in range(k)])
    return df.sparkSession.createDataFrame(scores, "model STRING, fold INT, score DOUBLE")


def tune(
    estimator: Estimator, grid: dict[str, Iterable], df: DataFrame, key: str, k: int,
    metric: str = "accuracy", parallelism: int = 4,
) -> tuple[DataFrame, object]:
    """Grid search by k-fold score: the table of points with their scores, and the best model.

    Where points tie, the model is that of the first; ``topk.last_of_best`` on the
    table picks the last.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    points = builder.build()
    folds = cut_lineage(
        spread(resample.kfold(df, key, k, seed=SEED).withColumn("fold", F.col("fold").cast("int")), df.count())
    )
    fitted = CrossValidator(
        estimator=estimator, estimatorParamMaps=points, numFolds=k, foldCol="fold", parallelism=parallelism,
        evaluator=evaluator(metric),
    ).fit(folds)
    rows = [
        (i, *[float(p[estimator.getParam(n)]) for n in grid], float(score))
        for i, (p, score) in enumerate(zip(points, fitted.avgMetrics))
    ]
    schema = "point INT, " + ", ".join(f"`{n}` DOUBLE" for n in grid) + ", score DOUBLE"
    return df.sparkSession.createDataFrame(rows, schema), fitted.bestModel


def probability_columns(
    scored: DataFrame, ident: str, classes: Iterable, prefix: str = "", column: str = "probability"
) -> DataFrame:
    """Id and one probability column per class."""
    p = vector_to_array(column)
    return scored.select(ident, *[p[i].alias(f"{prefix}{c}") for i, c in enumerate(classes)])


def normalised_scores(raw: Column) -> Column:
    """Raw per-class scores squeezed to sum to one; not calibrated probabilities."""
    weights = F.transform(raw, lambda v: F.exp(v - F.array_max(raw)))
    total = F.aggregate(weights, F.lit(0.0), lambda a, v: a + v)
    return F.transform(weights, lambda w: w / total)


def summary(scored: DataFrame, truth: str = "label", guess: str = "prediction") -> DataFrame:
    """Counts by true and guessed class."""
    return scored.groupBy(F.col(truth).cast("int").alias("label"), F.col(guess).cast("int").alias("prediction")).agg(
        F.count("*").alias("n")
    )
