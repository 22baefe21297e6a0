"""Model fitting on the shared tables.

Most models have no SQL form, but what they must find here has one: the label is
a step function of two columns, so it can be learned and is known.  Fits see
three quarters of the parts and are judged on the rest.  Trees and boosting must
give every unseen label exactly; of the others the count, the accuracy reached and
probabilities that add up to one are checked.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.operators import bagging, boosting, models, neighbours, resample, sgd, topk

_HELD_OUT = """
WITH p AS (SELECT p_partkey, p_size, p_size % 8 AS c, p_size // 8 AS r,
  ('0x' || substr(md5('1:' || p_partkey), 1, 8))::BIGINT / 4294967296.0 >= 0.75 AS unseen FROM part),
u AS (SELECT p_partkey, c, r, 2 * (c >= 4)::INT + (r >= 3)::INT AS label FROM p WHERE unseen)
"""
_EXACT = _HELD_OUT + "SELECT p_partkey, label, label AS prediction FROM u"
_EXACT_TWO = _HELD_OUT + "SELECT p_partkey, (c >= 4)::INT AS label, (c >= 4)::INT AS prediction FROM u"
_REACHED = _HELD_OUT + "SELECT count(*) AS n, true AS reached FROM u"
_SURE = _HELD_OUT + "SELECT count(*) AS n, true AS reached, true AS adds_up FROM u"


def _steps(t, classes: int = 4):
    """Parts with two features, the label they decide, and whether a fit may see them."""
    column, row = F.col("p_size") % 8, F.floor(F.col("p_size") / 8)
    high, far = (column >= 4).cast("double"), (row >= 3).cast("double")
    rows = t.part.select(
        "p_partkey", column.cast("double").alias("c"), row.cast("double").alias("r"),
        (2 * high + far if classes == 4 else high).alias("label"), (100 * high + 10 * far).alias("price"),
    )
    rows = VectorAssembler(inputCols=["c", "r"], outputCol="features").transform(rows)
    return resample.holdout(rows, "p_partkey", 0.75, seed=1)


def _unseen(estimator, rows):
    return estimator.fit(models.spread(rows.where("is_train"))).transform(rows.where("NOT is_train"))


def _predictions(scored):
    return scored.select(
        "p_partkey", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


def _reached(scored, accuracy: float):
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return scored.agg(F.count("*").alias("n"), (hit >= accuracy).alias("reached"))


def _sure(scored, accuracy: float):
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, v: a + v)
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return scored.agg(F.count("*").alias("n"), (hit >= accuracy).alias("reached"),
                      F.every(F.abs(total - 1) < 1e-9).alias("adds_up"))


def _prices(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").alias("label")
    )
    return VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(rows)


@query("fit_decision_tree", _EXACT)
def fit_decision_tree(t):
    return _predictions(_unseen(models.decision_tree(), _steps(t)))


@query("fit_decision_tree_regressor", _HELD_OUT + """
SELECT round(100.0 * (c >= 4)::INT + 10 * (r >= 3)::INT, 4)::DOUBLE AS leaf_price, count(*) AS n FROM u GROUP BY 1
""")
def fit_decision_tree_regressor(t):
    rows = _steps(t).withColumn("label", F.col("price"))
    scored = _unseen(models.decision_tree(regression=True, depth=3), rows)
    return scored.groupBy(F.round("prediction", 4).alias("leaf_price")).agg(F.count("*").alias("n"))


@query("fit_random_forest", _REACHED)
def fit_random_forest(t):
    return _reached(_unseen(models.random_forest(trees=100), _steps(t)), 0.9)


@query("fit_bagging", _EXACT)
def fit_bagging(t):
    return _predictions(_unseen(models.bagging(trees=20), _steps(t)))


@query("fit_boosted_trees", _EXACT_TWO)
def fit_boosted_trees(t):
    return _predictions(_unseen(models.boosted_trees(classes=2, rounds=20), _steps(t, 2)))


_NEW_POINTS = """
WITH u AS (SELECT p_partkey, 2 * (p_size % 8 >= 4)::INT + (p_size // 8 >= 3)::INT AS label FROM part WHERE p_size % 5 = 2)
"""


def _boosted_classes(t, rounds: int = 8):
    """Four classes learned from four fifths of the *points*; the rest have sizes that no fit has seen."""
    rows = _steps(t).withColumn("new", F.pmod(F.col("c") + 8 * F.col("r"), F.lit(5)) == 2)
    settings = boosting.Settings(rounds=rounds, depth=2, rate=0.5, rows=0.9)
    model = boosting.fit_boosted_classes(rows.where("NOT new"), "p_partkey", ["c", "r"], "label", 4, settings)
    return boosting.predict_boosted_classes(model, rows.where("new"), ["c", "r"])


@query("fit_boosted_classes", _NEW_POINTS + "SELECT p_partkey, label, label AS prediction FROM u")
def fit_boosted_classes(t):
    return _predictions(_boosted_classes(t))


@query("boosted_class_probabilities", _NEW_POINTS + """
SELECT label, count(*) AS n, true AS surest, 1.0::DOUBLE AS total FROM u GROUP BY label
""")
def boosted_class_probabilities(t):
    """Per true class: rows, whether that class is the surest on average, and what probabilities add up to."""
    scored = _boosted_classes(t).select("label", F.col("probability").alias("p"))
    own = F.get("p", F.col("label").cast("int"))
    return scored.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count("*").alias("n"), (F.avg(own) > 0.6).alias("surest"),
        F.round(F.avg(F.aggregate("p", F.lit(0.0), lambda a, x: a + x)), 6).alias("total"))


_BAGGED = ["c", "r", "c_down", "r_down"]


def _bagged(t, classes: int | None, label: str, columns: float):
    """A bag learned from four fifths of the points.  Each measure is there twice, so that three of four columns hold both."""
    rows = _steps(t).withColumns({"new": F.pmod(F.col("c") + 8 * F.col("r"), F.lit(5)) == 2,
                                  "c_down": 7 - F.col("c"), "r_down": 6 - F.col("r")})
    settings = bagging.Bag(trees=25, depth=3, columns=columns)
    model = bagging.fit_bag(rows.where("NOT new"), "p_partkey", _BAGGED, label, classes, settings)
    return bagging.predict_bag(model, rows.where("new"), _BAGGED)


@query("fit_bagged_classes", _NEW_POINTS + "SELECT p_partkey, label, label AS prediction FROM u")
def fit_bagged_classes(t):
    return _predictions(_bagged(t, 4, "label", 1.0))


@query("fit_bagged_subspaces", _NEW_POINTS + "SELECT p_partkey, label, label AS prediction FROM u")
def fit_bagged_subspaces(t):
    """Every tree sees three of four columns."""
    return _predictions(_bagged(t, 4, "label", 0.75))


@query("fit_bagged_regressor", _NEW_POINTS + """
SELECT p_partkey, 100.0::DOUBLE * (label // 2) + 10 * (label % 2) AS price, true AS close FROM u
""")
def fit_bagged_regressor(t):
    """The mean of 25 trees lies within 5 of the price, where steps are 10 and 100."""
    scored = _bagged(t, None, "price", 0.75)
    return scored.select("p_partkey", "price", (F.abs(F.col("prediction") - F.col("price")) < 5).alias("close"))


@query("fit_adaboost", _EXACT_TWO)
def fit_adaboost(t):
    rows = _steps(t, 2)
    learners = models.fit_adaboost(rows.where("is_train"), classes=2, rounds=10)
    return _predictions(models.predict_adaboost(learners, rows.where("NOT is_train"), classes=2))


@query("fit_knn", """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings),
n AS (SELECT a.vec_id AS query, b.label, row_number() OVER (PARTITION BY a.vec_id
  ORDER BY round(pow(list_distance(a.e, b.e), 2), 9), b.vec_id) AS place FROM v a JOIN v b ON a.vec_id <> b.vec_id),
c AS (SELECT query, label, count(*) AS n FROM n WHERE place <= 5 GROUP BY 1, 2),
w AS (SELECT query, label, row_number() OVER (PARTITION BY query ORDER BY n DESC, label) AS i FROM c)
SELECT query AS vec_id, label AS predicted FROM w WHERE i = 1
""")
def fit_knn(t):
    near = neighbours.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", "label", 5)
    return neighbours.vote(near).withColumnRenamed("query", "vec_id")


_BY_K = """
WITH v AS (SELECT vec_id, vec_id % 5 AS fold, embedding::DOUBLE[] AS e, label FROM embeddings),
n AS (SELECT a.vec_id AS query, b.label, row_number() OVER (PARTITION BY a.vec_id
  ORDER BY round(pow(list_distance(a.e, b.e), 2), 9), b.vec_id) AS place FROM v a JOIN v b ON a.fold <> b.fold),
c AS (SELECT query, k, label, count(*) AS n FROM n JOIN range(1, 16) g(k) ON place <= k GROUP BY 1, 2, 3),
w AS (SELECT query, k, label, row_number() OVER (PARTITION BY query, k ORDER BY n DESC, label) AS i FROM c),
s AS (SELECT k, avg((w.label = v.label)::INT::DOUBLE) AS accuracy FROM w JOIN v ON v.vec_id = query WHERE i = 1 GROUP BY 1)
"""


def _by_k(t):
    return neighbours.accuracy_by_k(
        t.embeddings.withColumn("fold", F.col("vec_id") % 5), "vec_id", "embedding", "label", "fold", 15)


@query("tune_knn", _BY_K + "SELECT k::BIGINT AS k, round(accuracy, 9) AS accuracy FROM s")
def tune_knn(t):
    """Accuracy of every number of neighbours up to 15, over five folds."""
    return _by_k(t).select(F.col("k").cast("bigint").alias("k"), F.round("accuracy", 9).alias("accuracy"))


@query("tune_knn_best", _BY_K + """
SELECT k::BIGINT AS k, round(accuracy, 9) AS accuracy FROM s ORDER BY accuracy DESC, k LIMIT 1
""")
def tune_knn_best(t):
    return neighbours.best_k(_by_k(t)).select(F.col("k").cast("bigint").alias("k"), F.round("accuracy", 9).alias("accuracy"))


@query("fit_logistic", _SURE)
def fit_logistic(t):
    return _sure(_unseen(models.logistic(0.0001), _steps(t)), 0.9)


_LINE = """
WITH m AS (SELECT corr(l_quantity, l_extendedprice) AS r, stddev_samp(l_quantity) AS sx, stddev_samp(l_extendedprice) AS sy,
  avg(l_quantity) AS mx, avg(l_extendedprice) AS my, count(*) AS n FROM lineitem)
"""


@query("fit_linear_penalised", _LINE + """,
k(kind, penalty, mix) AS (VALUES ('elastic', 1000.0, 0.5), ('lasso', 1000.0, 1.0), ('ridge', 1000.0, 0.0))
SELECT kind, round(sign(r) * greatest(abs(r) - mix * penalty / sy, 0) / (1 + (1 - mix) * penalty / sy) * sy / sx, 1)::DOUBLE AS slope
FROM m, k
""")
def fit_linear_penalised(t):
    """Ridge, lasso and their mixture; with one feature each has a closed form."""
    rows = _prices(t)
    kinds = {"ridge": 0.0, "elastic": 0.5, "lasso": 1.0}
    fitted = [(k, round(float(models.penalised_linear(1000.0, mix).fit(rows).coefficients[0]), 1)) for k, mix in kinds.items()]
    return t.spark.createDataFrame(fitted, "kind STRING, slope DOUBLE")


@query("fit_discriminant", """
WITH x AS (SELECT 2 * (p_size % 8 >= 4)::INT + (p_size // 8 >= 3)::INT AS label,
  (p_size % 8)::DOUBLE AS a, (p_size // 8)::DOUBLE AS b FROM part),
m AS (SELECT label, count(*) AS n, avg(a) AS ma, avg(b) AS mb, sum(count(*)) OVER () AS total FROM x GROUP BY 1),
v AS (SELECT sum((a - ma) * (a - ma)) / (count(*) - 4) AS aa, sum((a - ma) * (b - mb)) / (count(*) - 4) AS ab,
  sum((b - mb) * (b - mb)) / (count(*) - 4) AS bb FROM x JOIN m USING (label))
SELECT label, round(n / total, 6)::DOUBLE AS prior, round(ma, 6) AS mean_a, round(mb, 6) AS mean_b,
  round(bb / (aa * bb - ab * ab), 6) AS inverse_aa, round(aa / (aa * bb - ab * ab), 6) AS inverse_bb FROM m, v
""")
def fit_discriminant(t):
    """The fitted model itself: priors, means and the inverse of the shared covariance."""
    rows = _steps(t).select("label", F.array("c", "r").alias("v"))
    m = models.fit_discriminant(rows, "label", "v", ridge=0.0)
    fitted = [
        (int(label), *[round(float(x), 6) for x in (prior, mean[0], mean[1], inverse[0, 0], inverse[1, 1])])
        for label, prior, mean, inverse in zip(m["labels"], m["prior"], m["means"], m["inverse"])
    ]
    return t.spark.createDataFrame(
        fitted, "label INT, prior DOUBLE, mean_a DOUBLE, mean_b DOUBLE, inverse_aa DOUBLE, inverse_bb DOUBLE")


@query("predict_discriminant", _HELD_OUT + """
SELECT kind, count(*) AS n, true AS reached FROM u, (VALUES ('linear'), ('quadratic')) k(kind) GROUP BY 1
""")
def predict_discriminant(t):
    rows = _steps(t).withColumn("v", F.array("c", "r"))
    parts = []
    for kind in ("linear", "quadratic"):
        model = models.fit_discriminant(rows.where("is_train"), "label", "v", kind == "quadratic", ridge=0.01)
        scored = models.predict_discriminant(model, rows.where("NOT is_train"), "v")
        parts.append(_reached(scored, 0.8).withColumn("kind", F.lit(kind)))
    return parts[0].union(parts[1])


# the model widens every variance by a billionth of the widest feature's
@query("fit_naive_bayes", """
WITH x AS (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
w AS (SELECT max(v) AS widest FROM (SELECT var_pop(x) AS v FROM x GROUP BY dim))
SELECT label, dim::INT AS dim, round(avg(x), 8) AS mean, round(var_pop(x) + any_value(widest) * 1e-9::DOUBLE, 8) AS variance
FROM x, w GROUP BY 1, 2
""")
def fit_naive_bayes(t):
    """Means and variances of the fitted model."""
    model = models.naive_bayes().fit(models.embedding_rows(t.embeddings))
    mean, variance = model.theta.toArray(), model.sigma.toArray()
    fitted = [(c, d, round(float(mean[c, d]), 8), round(float(variance[c, d]), 8))
              for c in range(mean.shape[0]) for d in range(mean.shape[1])]
    return t.spark.createDataFrame(fitted, "label INT, dim INT, mean DOUBLE, variance DOUBLE")


@query("fit_linear_svm", _REACHED)
def fit_linear_svm(t):
    return _reached(_unseen(models.linear_svm(classes=4, reg=0.0001), _steps(t)), 0.6)


@query("fit_mlp", _SURE)
def fit_mlp(t):
    return _sure(_unseen(models.perceptron([2, 16, 4], rounds=200), _steps(t)), 0.9)


@query("fit_deep_linear", _LINE + """
SELECT 'one' AS layers, round(r * sy / sx, 4) AS slope, round(my - r * sy / sx * mx, 1) AS intercept FROM m
UNION ALL SELECT 'ridge', round(r / (1 + 1000.0 / sy) * sy / sx, 4), round(my - r / (1 + 1000.0 / sy) * sy / sx * mx, 1) FROM m
""")
def fit_deep_linear(t):
    """Layers without activation are one linear map, with or without a penalty on its weights."""
    rows = _prices(t)
    found = {"one": models.stacked_linear(), "ridge": models.penalised_linear(1000.0, 0.0)}
    fitted = []
    for name, estimator in found.items():
        model = estimator.fit(rows)
        fitted.append((name, round(float(model.coefficients[0]), 4), round(float(model.intercept), 1)))
    return t.spark.createDataFrame(fitted, "layers STRING, slope DOUBLE, intercept DOUBLE")


_FOLDS = 5


@query("cv_evaluate", f"""
SELECT model, {_FOLDS}::BIGINT AS folds, true AS reached FROM (VALUES ('tree'), ('bayes'), ('logistic'), ('auc')) m(model)
WHERE (SELECT count(*) FROM part) > 0
""")
def cv_evaluate(t):
    """Mean scores over folds: accuracy of three models, area under the curve of one."""
    rows, two = _steps(t), _steps(t, 2)
    tried = {"tree": models.decision_tree(), "bayes": models.naive_bayes(), "logistic": models.logistic(0.0001)}
    scores = models.cross_validate(tried, rows, "p_partkey", _FOLDS).union(
        models.cross_validate({"auc": models.logistic(0.0001)}, two, "p_partkey", _FOLDS, "areaUnderROC"))
    least = F.when(F.col("model") == "tree", 1.0).when(F.col("model") == "bayes", 0.8).otherwise(0.9)
    return scores.groupBy("model").agg(F.count("*").alias("folds"), F.avg("score").alias("s")).select(
        "model", "folds", (F.col("s") >= least).alias("reached"))


@query("cv_regression", f"""
SELECT model, {_FOLDS}::BIGINT AS folds, true AS reached
FROM (VALUES ('forest'), ('bagging'), ('boosting'), ('elastic')) m(model) WHERE (SELECT count(*) FROM part) > 0
""")
def cv_regression(t):
    """Root mean squared error per regressor; prices step by 100 and 10."""
    rows = _steps(t).withColumn("label", F.col("price"))
    tried = {
        "forest": models.random_forest(regression=True, trees=50), "bagging": models.bagging(regression=True, trees=20),
        "boosting": models.boosted_trees(classes=None, rounds=20), "elastic": models.penalised_linear(0.1, 0.5),
    }
    scores = models.cross_validate(tried, rows, "p_partkey", _FOLDS, "rmse")
    most = F.when(F.col("model") == "elastic", 40.0).when(F.col("model") == "forest", 25.0).otherwise(0.001)
    return scores.groupBy("model").agg(F.count("*").alias("folds"), F.avg("score").alias("s")).select(
        "model", "folds", (F.col("s") <= most).alias("reached"))


@query("tune_grid", """
SELECT stage, setting::DOUBLE AS setting, setting > 1 AS exact FROM (VALUES
  ('shape', 1), ('shape', 2), ('shape', 3), ('shape', 4), ('shape', 5), ('size', 5), ('size', 10), ('size', 20)) g(stage, setting)
WHERE (SELECT count(*) FROM part) > 0
""")
def tune_grid(t):
    """Two stages: the shape of the trees first, then their number with that shape.

    Two splits tell the four classes apart, so one level is not enough.
    """
    rows = _steps(t)
    shape, _ = models.tune(models.bagging(trees=5), {"maxDepth": [1, 2, 3, 4, 5]}, rows, "p_partkey", _FOLDS)
    depth = int(topk.last_of_best(shape, "score", "point").first()["maxDepth"])
    size, _ = models.tune(models.bagging(depth=depth), {"numTrees": [5, 10, 20]}, rows, "p_partkey", _FOLDS)
    exact = (F.col("score") >= 1 - 1e-12).alias("exact")
    return shape.select(F.lit("shape").alias("stage"), F.col("maxDepth").alias("setting"), exact).union(
        size.select(F.lit("size"), "numTrees", exact))


@query("tune_regression", """
SELECT setting::DOUBLE AS setting, setting = 0.01 AS best FROM (VALUES (0.01), (10.0), (1000.0)) g(setting)
WHERE (SELECT count(*) FROM part) > 0
""")
def tune_regression(t):
    """The penalty of an elastic net by cross-validated error: the smallest error wins."""
    rows = _steps(t).withColumn("label", F.col("price"))
    points, model = models.tune(
        models.penalised_linear(0.0, 0.5), {"regParam": [0.01, 10.0, 1000.0]}, rows, "p_partkey", _FOLDS, "rmse")
    least = points.agg(F.min("score")).scalar()
    return points.select(F.col("regParam").alias("setting"), (F.col("score") == least).alias("best"))


@query("predict_class", _EXACT)
def predict_class(t):
    return _predictions(_unseen(models.decision_tree(), _steps(t)))


@query("predict_prob", _HELD_OUT + "SELECT p_partkey, label, true AS adds_up, true AS most_likely FROM u")
def predict_prob(t):
    """One probability per class and unseen part; the label's is the largest."""
    scored = _unseen(models.bagging(trees=20), _steps(t))
    named = models.probability_columns(scored.withColumn("keep", F.struct("p_partkey", "label")), "keep", range(4), prefix="p_")
    p = F.array(*[F.col(f"p_{i}") for i in range(4)])
    return named.select(
        "keep.p_partkey", F.col("keep.label").cast("int").alias("label"),
        (F.abs(F.aggregate(p, F.lit(0.0), lambda a, v: a + v) - 1) < 1e-9).alias("adds_up"),
        (F.array_position(p, F.array_max(p)) - 1 == F.col("keep.label")).alias("most_likely"))


@query("predict_prob_one_vs_rest", _HELD_OUT + "SELECT p_partkey, label, true AS adds_up, true AS most_likely FROM u")
def predict_prob_one_vs_rest(t):
    """A boosted machine per class has scores but no probabilities; they are squeezed to sum to one."""
    scored = _unseen(models.boosted_trees(classes=4, rounds=20), _steps(t))
    p = models.normalised_scores(vector_to_array("rawPrediction"))
    return scored.select("p_partkey", F.col("label").cast("int").alias("label"), p.alias("p")).select(
        "p_partkey", "label", (F.abs(F.aggregate("p", F.lit(0.0), lambda a, v: a + v) - 1) < 1e-9).alias("adds_up"),
        (F.array_position("p", F.array_max("p")) - 1 == F.col("label")).alias("most_likely"))


@query("fit_sgd", _NEW_POINTS + """
SELECT loss, p_partkey, label, label AS prediction FROM u, (VALUES ('log')) k(loss)
UNION ALL SELECT 'hinge', p_partkey, (p_size % 8 >= 4)::INT, (p_size % 8 >= 4)::INT FROM part WHERE p_size % 5 = 2
""")
def fit_sgd(t):
    """Four classes by softmax, two by hinge, both on points that no fit has seen."""
    parts = []
    for loss, classes in (("log", 4), ("hinge", 2)):
        rows = _steps(t, classes).withColumn("new", F.pmod(F.col("c") + 8 * F.col("r"), F.lit(5)) == 2)
        settings = sgd.Settings(loss=loss, epochs=15, batch=4, rate=1.0, penalty=0.0)
        model = sgd.fit_sgd(rows.where("NOT new"), ["c", "r"], "label", classes, settings)
        scored = _predictions(sgd.predict_sgd(model, rows.where("new"), ["c", "r"]))
        parts.append(scored.withColumn("loss", F.lit(loss)))
    return parts[0].union(parts[1])
