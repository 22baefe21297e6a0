"""Linear classifiers by stochastic gradient descent, epochs run shard by shard."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.session import written


@dataclass(frozen=True)
class Settings:
    """``loss`` is ``log`` (one softmax over all classes) or ``hinge`` (each class against the rest)."""

    loss: str = "log"
    epochs: int = 10
    batch: int = 32
    rate: float = 0.5
    penalty: float = 1e-5
    shard_rows: int = 8192
    seed: int = 1


def _shards(df: DataFrame, features: Sequence[str], label: str, classes: int, s: Settings):
    """Shards of about ``shard_rows`` different rows, one record each, and the features' means and spreads.

    Equal rows are one row with a weight, so no value can crowd a shard, and a shard's rows follow
    from their values alone.
    """
    plain = df.select(
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("int").alias("y"))
    names = plain.columns
    known = plain.dropna().where(F.col("y").between(0, classes - 1))
    rows = written(known.groupBy(*names).agg(F.count("*").cast("double").alias("w")), "sgd-rows")
    # moments around a first guess of the mean, so that large offsets do not cancel
    total = rows.agg(F.count("*").alias("n"), F.sum("w").alias("w"), *[
        F.try_divide(F.sum(F.col("w") * F.col(x)), F.sum("w")).alias(x) for x in names[:-1]]).head()
    if not total["n"]:
        raise ValueError("no row with a label in range and all features")
    means = [total[x] for x in names[:-1]]
    second = rows.agg(*[F.sum(F.col("w") * F.pow(F.col(x) - m, 2)) / total["w"] for x, m in zip(names, means)]).head()
    spreads = [float(np.sqrt(v)) or 1.0 for v in second]
    count = max(1, -(-total["n"] // s.shard_rows))
    drawn = F.pmod(F.xxhash64(F.lit(s.seed), *names), F.lit(count)).alias("shard")
    row = F.array(*[(F.col(x) - m) / d for x, m, d in zip(names, means, spreads)], F.lit(1.0), F.col("y").cast("double"), F.col("w"))
    packed = rows.select(drawn, row.alias("row")).groupBy("shard").agg(
        F.flatten(F.sort_array(F.collect_list("row"))).alias("rows"))
    return written(packed, "sgd-shards"), means, spreads


def _epoch(weights: np.ndarray, rows: np.ndarray, s: Settings, rate: float, draw: np.random.Generator) -> np.ndarray:
    """One pass over a shard in mini-batches of shuffled rows."""
    w = weights.copy()
    order = draw.permutation(len(rows))
    for at in range(0, len(rows), s.batch):
        part = rows[order[at:at + s.batch]]
        x, y, weight = part[:, :-2], part[:, -2].astype(int), part[:, -1]
        scores = x @ w.T
        if s.loss == "log":
            p = np.exp(scores - scores.max(1, keepdims=True))
            slope = p / p.sum(1, keepdims=True)
            slope[np.arange(len(y)), y] -= 1
        else:
            sign = np.where(np.arange(len(w)) == y[:, None], 1.0, -1.0)
            slope = np.where(sign * scores < 1, -sign, 0.0)
        step = (slope * (weight / weight.sum())[:, None]).T @ x
        step[:, :-1] += s.penalty * w[:, :-1]  # the constant is not held back
        w -= rate * step
    return w


def fit_sgd(df: DataFrame, features: Sequence[str], label: str, classes: int, settings: Settings = Settings()) -> dict:
    """A linear classifier of labels ``0 .. classes - 1``.

    Every epoch starts all shards from the same weights, runs mini-batches inside each shard and
    averages the results by the rows behind them; steps shrink with the root of the epoch.  What an epoch
    moves is one model per task; the rows are shuffled once.  Features are centred and scaled.
    Rows with a null feature or a label out of range are left out; without any row it is an error.
    Repeated rows weigh by their number.  The same rows and seed give the same model up to the
    rounding of sums, however the table is partitioned.
    """
    s = settings
    if s.loss not in ("log", "hinge"):
        raise ValueError(f"unknown loss {s.loss}")
    shards, means, spreads = _shards(df, features, label, classes, s)
    width = len(features) + 1
    weights = np.zeros((classes, width))
    for epoch in range(s.epochs):
        start, rate = weights, s.rate / np.sqrt(epoch + 1)

        def train(batches, start=start, rate=rate, epoch=epoch):
            total = np.zeros(1 + classes * width)
            for frame in batches:
                for shard, flat in zip(frame["shard"], frame["rows"]):
                    rows = np.asarray(flat, dtype="f8").reshape(-1, width + 2)
                    w = _epoch(start, rows, s, rate, np.random.default_rng((s.seed, epoch, int(shard))))
                    n = rows[:, -1].sum()
                    total += np.concatenate([[n], n * w.ravel()])
            yield pd.DataFrame({"sums": [total.tolist()]})

        parts = shards.mapInPandas(train, "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
        added = np.array([r[0] for r in parts.groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").select("v").collect()])
        weights = (added[1:] / added[0]).reshape(classes, width)
    scaled = weights[:, :-1] / np.array(spreads)
    return {"weights": scaled, "constant": weights[:, -1] - scaled @ np.array(means), "loss": s.loss}


def predict_sgd(model: dict, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``scores`` and ``prediction``, after a ``log`` fit also ``probability``; the smallest class wins a tie.

    All three are null where a feature is null.
    """
    score = lambda row, constant: reduce(
        lambda a, b: a + b, [F.lit(float(w)) * F.col(f).cast("double") for w, f in zip(row, features)], F.lit(float(constant)))
    scores = F.array(*[score(row, c) for row, c in zip(model["weights"], model["constant"])])
    whole = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in features], F.lit(True))
    out = df.withColumn("scores", F.when(whole, scores))
    best = F.array_position("scores", F.array_max("scores")) - 1
    out = out.withColumn("prediction", best.cast("double"))
    if model["loss"] != "log":
        return out
    raised = F.transform("scores", lambda v: F.exp(v - F.array_max("scores")))
    total = F.aggregate(raised, F.lit(0.0), lambda a, v: a + v)
    return out.withColumn("probability", F.transform(raised, lambda v: v / total))
