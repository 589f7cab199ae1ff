import math
import os

import pytest
from pyspark.sql import functions as F

from marginalia.operators import estimators as est
from marginalia.operators import evaluate, neighbours, tuning
from marginalia.operators.split import one_vs_rest_label
from marginalia.sources import labelled

from samples import LOANS

MEASURES = ["sepal_length", "sepal_width", "petal_length", "petal_width"]


@pytest.fixture(scope="module")
def three_classes(spark):
    """Three overlapping bands of points with non-negative features, by a rule."""
    ids = spark.range(300)
    noise = [F.pmod(F.xxhash64("id", F.lit(s)), F.lit(100)) / 50 for s in range(3)]
    k = (F.col("id") % 3).cast("double")
    shifted = ids.select("id", k.alias("label"), (k * 2 + noise[0]).alias("a"), (5 - k + noise[1]).alias("b"), noise[2].alias("c"))
    return labelled.with_features(shifted, ["a", "b", "c"]).cache()


def train_accuracy(estimator, points):
    scored = est.score(est.fit(estimator, points), points)
    return evaluate.accuracy(scored).first().accuracy


def test_tree_on_loans(spark):
    points = labelled.inline_points(spark, LOANS)
    model = est.fit(est.decision_tree(), points)
    assert evaluate.accuracy(est.score(model, points)).first().correct == 15
    described = est.tree_description(model, points).first()
    assert (described.depth, described.nodes) == (2, 5)
    rules = [line.strip() for line in described.rules.splitlines()[1:]]
    assert rules[:2] == ["If (feature 2 <= 1.5)", "Predict: 1.0"] and "If (feature 1 <= 1.5)" in rules
    assert sum(described.importances) == pytest.approx(1.0)


def test_naive_bayes_by_formula(three_classes):
    model = est.fit(est.naive_bayes(), three_classes)
    sums = {r.label: r for r in three_classes.groupBy("label").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in "abc"]).collect()}
    for row in est.naive_bayes_priors(model, three_classes).collect():
        assert row.pi == pytest.approx(math.log(sums[row.label].n + 1) - math.log(303))
    for row in est.naive_bayes_likelihoods(model, three_classes, ["a", "b", "c"]).collect():
        of = sums[row.label]
        assert row.theta == pytest.approx(math.log(of[row.feature] + 1) - math.log(of.a + of.b + of.c + 3))


def test_naive_bayes_refuses_negative_features(spark):
    points = labelled.inline_points(spark, [(0.0, [1.0]), (1.0, [-1.0])])
    with pytest.raises(Exception, match="(?i)nonnegative|negative"):
        est.fit(est.naive_bayes(), points)


@pytest.mark.parametrize(
    "estimator", ["decision_tree", "logistic_regression", "one_vs_rest_svm", "network", "gaussian"]
)
def test_classifiers_learn(three_classes, estimator):
    made = {
        "decision_tree": est.decision_tree,
        "logistic_regression": est.logistic_regression,
        "one_vs_rest_svm": lambda: est.one_vs_rest_svm(max_iter=30),
        "network": lambda: est.multilayer_perceptron([3, 6, 3]),
        "gaussian": lambda: est.naive_bayes(model_type="gaussian"),
    }[estimator]()
    assert train_accuracy(made, three_classes) >= 0.85


def test_binary_svm_refuses_a_third_class(three_classes):
    with pytest.raises(Exception, match="(?i)label"):
        est.fit(est.linear_svm(), three_classes)


def test_scoring_all_models_at_once(three_classes):
    points = three_classes.withColumn("split", F.when(F.col("id") % 4 < 3, "train").otherwise("test"))
    models = {"bayes": est.fit(est.naive_bayes(), points), "tree": est.fit(est.decision_tree(max_depth=2), points)}
    together = evaluate.report_all(est.score_all(models, points), list(models), "bands")
    apart = [evaluate.report(est.score(model, points), name, "bands") for name, model in models.items()]
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, apart[0].union(apart[1]).collect()))


def test_coefficients(three_classes):
    model = est.fit(est.logistic_regression(), three_classes)
    rows = est.linear_coefficients(model, three_classes, ["a", "b", "c"]).collect()
    assert len(rows) == 3 * 4 and {r.feature for r in rows} == {"", "a", "b", "c"}


def test_training_rows_keep_large_tables_apart(spark, monkeypatch):
    points = labelled.inline_points(spark, LOANS).repartition(4)
    with est.training_rows(points) as rows:
        assert rows.rdd.getNumPartitions() == 1
    monkeypatch.setattr(est, "ROWS_PER_TASK", 1)
    with est.training_rows(points) as rows:
        assert rows.rdd.getNumPartitions() == 4
    with est.training_rows(points.coalesce(1)) as rows:
        assert rows.rdd.getNumPartitions() == 4 and rows.count() == 15
    with est.training_rows(points.repartition(6)) as rows:
        assert rows.rdd.getNumPartitions() == 6


def test_search(spark, three_classes):
    pair = three_classes.withColumn("label", one_vs_rest_label(F.col("label"), 1.0))
    assert len(tuning.logistic_grid(est.logistic_regression())) == 18
    lr = est.logistic_regression()
    grid = tuning.logistic_grid(lr, reg_params=[0.001, 1.0], intercepts=[True], elastic_nets=[0.5])
    model = tuning.search(pair, lr, grid)
    rows = tuning.search_results(model, pair).collect()
    assert len(rows) == 2 * 4 and all(0.0 <= r.metric <= 1.0 for r in rows)
    best = {r.param: r.value for r in tuning.best_parameters(model, pair).collect()}
    top = max(rows, key=lambda r: r.metric)
    assert best["regParam"] == next(r.value for r in rows if r.setting == top.setting and r.param == "regParam")


def test_binary_evaluator_refuses_three_classes(three_classes):
    lr = est.logistic_regression()
    grid = tuning.logistic_grid(lr, reg_params=[0.01], intercepts=[True], elastic_nets=[1.0])
    with pytest.raises(Exception, match="length=2"):
        tuning.search(three_classes, lr, grid)


@pytest.fixture(scope="module")
def iris(spark):
    path = os.environ.get("IRIS_CSV")
    if not path:
        pytest.skip("IRIS_CSV names no file")
    flowers = labelled.read_measurements(spark, path, MEASURES)
    table = labelled.with_features(labelled.with_label(flowers, "species"), MEASURES)
    return table.select("label", "features", *MEASURES).cache()


def test_iris_bayes(iris):
    model = est.fit(est.naive_bayes(), iris)
    theta = [[round(float(v), 8) for v in row] for row in model.theta.toArray()]
    assert theta == [
        [-0.70893906, -1.08867359, -1.92882235, -3.65536968],
        [-0.88088275, -1.63924027, -1.21132886, -2.36814464],
        [-0.95779046, -1.74946121, -1.12831744, -2.13018483],
    ]
    assert evaluate.accuracy(est.score(model, iris)).first().correct == 143


@pytest.mark.parametrize(
    "name, bound", [("gaussian", 0.93), ("tree", 0.97), ("logistic", 0.95), ("svm", 0.90), ("network", 0.93)]
)
def test_iris_accuracy(iris, name, bound):
    made = {
        "gaussian": lambda: est.naive_bayes(model_type="gaussian"),
        "tree": est.decision_tree,
        "logistic": est.logistic_regression,
        "svm": est.one_vs_rest_svm,
        "network": lambda: est.multilayer_perceptron([4, 8, 3]),
    }[name]()
    assert train_accuracy(made, iris) >= bound


def test_iris_neighbours(iris):
    rows = iris.select(F.monotonically_increasing_id().alias("id"), F.array(*MEASURES).alias("features"), "label")
    train, test = rows.filter("id % 4 < 3"), rows.filter("id % 4 = 3")
    predicted = neighbours.majority(neighbours.nearest(train, test, 5))
    scored = test.join(predicted, "id", "left")
    assert evaluate.accuracy(scored).first().accuracy >= 0.80
