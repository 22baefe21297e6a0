"""Metrics on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.operators import metrics, sets

_GUESS = """
WITH g AS (SELECT l.doc_id, l.quality::BIGINT AS truth, (d.n_chars > 1000 AND l.toxic = 0)::BIGINT AS guess,
  d.lang, d.n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""


def _guessed(t):
    docs = t.documents.select("doc_id", "lang", "n_chars")
    return t.labels.join(docs, "doc_id").select(
        "doc_id", F.col("quality").cast("bigint").alias("truth"),
        ((F.col("n_chars") > 1000) & (F.col("toxic") == 0)).cast("bigint").alias("guess"), "lang", "n_chars",
    )


def _brand_guess(t):
    means = t.part.groupBy("p_brand").agg(F.avg("p_retailprice").alias("guess"))
    return t.part.join(means, "p_brand").select(F.col("p_retailprice").alias("price"), "guess")


_BRAND = """
b AS (SELECT p_retailprice AS price, avg(p_retailprice) OVER (PARTITION BY p_brand) AS guess FROM part)
"""


@query("metric_accuracy", _GUESS + "SELECT round(avg((truth = guess)::INT), 9) AS accuracy FROM g")
def metric_accuracy(t):
    return _guessed(t).agg(F.round(metrics.accuracy("truth", "guess"), 9).alias("accuracy"))


@query("metric_confusion", _GUESS + "SELECT truth, guess, count(*) AS n FROM g GROUP BY 1, 2")
def metric_confusion(t):
    return metrics.confusion(_guessed(t), "truth", "guess")


_CLASSES = _GUESS + """,
c AS (SELECT truth AS class FROM g UNION SELECT guess FROM g),
s AS (SELECT class, count(*) FILTER (truth = class) AS t, count(*) FILTER (guess = class) AS p,
  count(*) FILTER (truth = class AND guess = class) AS h FROM c, g GROUP BY 1),
m AS (SELECT class, h / nullif(p, 0) AS precision, h / nullif(t, 0) AS recall FROM s),
f AS (SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1 FROM m)
"""


@query("metric_precision_recall_f1", _CLASSES + """
SELECT class::VARCHAR AS class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM f
UNION ALL SELECT 'macro', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9) FROM f
""")
def metric_precision_recall_f1(t):
    scores = metrics.class_scores(_guessed(t), "truth", "guess")
    macro = metrics.macro_scores(scores).withColumn("class", F.lit("macro"))
    both = scores.withColumn("class", F.col("class").cast("string")).unionByName(macro)
    return both.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("metric_rmse", "WITH " + _BRAND + "SELECT round(sqrt(avg((price - guess) * (price - guess))), 8) AS rmse FROM b")
def metric_rmse(t):
    return _brand_guess(t).agg(F.round(metrics.rmse("price", "guess"), 8).alias("rmse"))


_RATES = _GUESS + """,
r AS (SELECT lang, avg(truth) AS p FROM g GROUP BY 1),
q AS (SELECT g.*, CASE WHEN truth = 1 THEN p ELSE 1 - p END AS p_true FROM g JOIN r USING (lang))
"""


@query("metric_log_loss", _RATES + "SELECT round(-avg(ln(greatest(p_true, 1e-15))), 8) AS log_loss FROM q")
def metric_log_loss(t):
    rows = _guessed(t)
    rates = rows.groupBy("lang").agg(F.avg("truth").alias("p"))
    p_true = F.when(F.col("truth") == 1, F.col("p")).otherwise(1 - F.col("p"))
    return rows.join(rates, "lang").agg(F.round(metrics.log_loss(p_true), 8).alias("log_loss"))


_AUC = """
k AS (SELECT truth, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0::DOUBLE AS r FROM g),
a AS (SELECT count(*) FILTER (truth = 1) AS n1, count(*) FILTER (truth = 0) AS n0,
  sum(r) FILTER (truth = 1) AS s FROM k)
"""


@query("metric_roc_auc", _GUESS + "," + _AUC + """
SELECT 1::BIGINT AS class, round((s - n1 * (n1 + 1) / 2.0::DOUBLE) / (n1 * n0), 9) AS auc FROM a
UNION ALL SELECT 0, round((s - n1 * (n1 + 1) / 2.0::DOUBLE) / (n1 * n0), 9) FROM a
""")
def metric_roc_auc(t):
    # brevity ranks the other class, so both areas must come out equal
    scored = _guessed(t).withColumn("brevity", -F.col("n_chars"))
    by_class = metrics.roc_auc_one_vs_rest(scored, "truth", {1: "n_chars", 0: "brevity"})
    return by_class.select(F.col("class").cast("bigint").alias("class"), F.round("auc", 9).alias("auc"))


@query("compare_models", _GUESS + "," + _BRAND + """
SELECT 'length rule' AS model, 'accuracy' AS metric, round(avg((truth = guess)::INT), 9) AS value FROM g
UNION ALL SELECT 'always good', 'accuracy', round(avg((truth = 1)::INT), 9) FROM g
UNION ALL SELECT 'brand mean', 'rmse', round(sqrt(avg((price - guess) * (price - guess))), 9) FROM b
""")
def compare_models(t):
    rows = _guessed(t).withColumn("always", F.lit(1))
    one = lambda df, model, metric, value: df.agg(F.round(value, 9).alias("value")).select(
        F.lit(model).alias("model"), F.lit(metric).alias("metric"), "value"
    )
    return sets.stack(
        one(rows, "length rule", "accuracy", metrics.accuracy("truth", "guess")),
        one(rows, "always good", "accuracy", metrics.accuracy("truth", "always")),
        one(_brand_guess(t), "brand mean", "rmse", metrics.rmse("price", "guess")),
    ).orderBy("metric", F.desc("value"))


@query("baseline_rate", """
WITH c AS (SELECT o_orderpriority AS k, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS i
  FROM orders GROUP BY 1), s AS (SELECT sum(n)::DOUBLE AS total FROM c)
SELECT 1 AS classes, round(sum(n)::DOUBLE / any_value(total), 9) AS rate FROM c, s WHERE i <= 1
UNION ALL SELECT 2, round(sum(n)::DOUBLE / any_value(total), 9) FROM c, s WHERE i <= 2
""")
def baseline_rate(t):
    return metrics.top_class_rates(t.orders, "o_orderpriority").withColumn("rate", F.round("rate", 9))


# the score of a class is higher for its own rows, and differently so for every class
_PAIRS = """
WITH k(class, step) AS (VALUES ('1-URGENT', 3), ('2-HIGH', 5), ('3-MEDIUM', 7), ('4-NOT SPECIFIED', 11), ('5-LOW', 13)),
s AS (SELECT o_orderpriority AS label, class,
  (o_orderkey * step) % 101 + CASE WHEN o_orderpriority = class THEN 2 * step ELSE 0 END AS score FROM orders, k),
g AS (SELECT s.*, a.class AS against FROM s JOIN k a ON a.class <> s.class AND label IN (s.class, a.class)),
r AS (SELECT class, against, label = class AS own, rank() OVER w + (count(*) OVER t - 1) / 2.0::DOUBLE AS r FROM g
  WINDOW w AS (PARTITION BY class, against ORDER BY score), t AS (PARTITION BY class, against, score)),
p AS (SELECT class, against, sum(r) FILTER (own) AS s, count(*) FILTER (own)::DOUBLE AS n1, count(*) FILTER (NOT own)::DOUBLE AS n0
  FROM r GROUP BY 1, 2),
a AS (SELECT class, against, (s - n1 * (n1 + 1) / 2) / (n1 * n0) AS auc FROM p)
"""
_STEPS = {"1-URGENT": 3, "2-HIGH": 5, "3-MEDIUM": 7, "4-NOT SPECIFIED": 11, "5-LOW": 13}


def _priority_scores(t):
    score = lambda name, step: (F.col("o_orderkey") * step) % 101 + F.when(
        F.col("o_orderpriority") == name, 2 * step).otherwise(0)
    scored = t.orders.select("o_orderpriority", *[score(c, k).alias(f"s{k}") for c, k in _STEPS.items()])
    return metrics.roc_auc_pairs(scored, "o_orderpriority", {c: f"s{k}" for c, k in _STEPS.items()})


@query("metric_roc_auc_pairs", _PAIRS + "SELECT class, against, round(auc, 9) AS auc FROM a")
def metric_roc_auc_pairs(t):
    return _priority_scores(t).withColumn("auc", F.round("auc", 9))


@query("metric_roc_auc_hand_till", _PAIRS + "SELECT round(avg(auc), 9) AS auc FROM a")
def metric_roc_auc_hand_till(t):
    return metrics.roc_auc_hand_till(_priority_scores(t)).withColumn("auc", F.round("auc", 9))
