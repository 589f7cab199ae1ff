"""The classifiers that Spark ML provides, with the settings this library promises.

All take a labelled-point table (``label``, ``features``) and return a fitted Spark ML model;
``score`` applies one. Training never brings rows to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Below this a training job's task is mostly overhead.
ROWS_PER_TASK = 20_000


def naive_bayes(smoothing: float = 1.0, model_type: str = "multinomial") -> NaiveBayes:
    """Naive Bayes. The multinomial form refuses negative features."""
    return NaiveBayes(smoothing=smoothing, modelType=model_type)


def decision_tree(max_depth: int = 5, max_bins: int = 32, seed: int = 1) -> DecisionTreeClassifier:
    """A classification tree that splits by Gini impurity."""
    return DecisionTreeClassifier(impurity="gini", maxDepth=max_depth, maxBins=max_bins, seed=seed)


def logistic_regression(
    reg_param: float = 0.0001,
    elastic_net_param: float = 1.0,
    max_iter: int = 30,
    aggregation_depth: int = 2,
) -> LogisticRegression:
    """Logistic regression with an L1 penalty; two classes or many, by the labels.

    Raise ``aggregation_depth`` for wide models on many executors.
    """
    return LogisticRegression(
        regParam=reg_param,
        elasticNetParam=elastic_net_param,
        maxIter=max_iter,
        aggregationDepth=aggregation_depth,
    )


def linear_svm(reg_param: float = 0.0, max_iter: int = 100) -> LinearSVC:
    """A linear support vector machine; labels must be 0 and 1."""
    return LinearSVC(regParam=reg_param, maxIter=max_iter)


def one_vs_rest_svm(reg_param: float = 0.0, max_iter: int = 100, parallelism: int = 4) -> OneVsRest:
    """One linear support vector machine per class."""
    return OneVsRest(classifier=linear_svm(reg_param, max_iter), parallelism=parallelism)


def multilayer_perceptron(
    layers: Sequence[int], max_iter: int = 100, seed: int = 1
) -> MultilayerPerceptronClassifier:
    """A feed-forward network; ``layers`` runs from the feature count to the class count."""
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter, seed=seed)


def fit(estimator: Estimator, train: DataFrame) -> Model:
    """Fit on ``label`` and ``features``, held on the executors (memory, then disk) meanwhile.

    The estimators read their input several times; holding these two columns keeps them from
    parsing the source again. What a lost executor held is computed again.
    """
    with training_rows(train) as rows:
        return estimator.fit(rows)


@contextmanager
def training_rows(train: DataFrame) -> Iterator[DataFrame]:
    """``(label, features)`` of ``train``, held for the time of a training.

    One large split goes to all cores, but as iterative training runs many short jobs, few rows go
    into few partitions. Tables of many splits and many rows keep theirs.
    """
    held = train.select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    spread_out = None
    try:
        tasks = math.ceil(held.count() / ROWS_PER_TASK) or 1
        splits = held.rdd.getNumPartitions()
        wanted = min(tasks, train.sparkSession.sparkContext.defaultParallelism)
        if tasks < splits:
            yield held.coalesce(tasks)
        elif splits < wanted:
            spread_out = held.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK)
            yield spread_out
        else:
            yield held
    finally:
        if spread_out is not None:
            spread_out.unpersist()
        held.unpersist()


def score(model: Model, points: DataFrame) -> DataFrame:
    """``points`` with ``prediction`` (and the model's raw scores)."""
    return model.transform(points)


def score_all(models: Mapping[str, Model], points: DataFrame) -> DataFrame:
    """``points`` with one prediction column per model, ``prediction of <name>``, in one pass."""
    for name, model in models.items():
        named = model.copy().setPredictionCol(f"prediction of {name}")
        points = named.setRawPredictionCol("").setProbabilityCol("").transform(points)
    return points


def naive_bayes_priors(model: Model, points: DataFrame) -> DataFrame:
    """``(label, pi)``: the log prior of every class."""
    rows = [(float(c), float(v)) for c, v in enumerate(model.pi.toArray())]
    return points.sparkSession.createDataFrame(rows, "label double, pi double")


def naive_bayes_likelihoods(model: Model, points: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(label, feature, theta)``: the log likelihood of every feature in every class."""
    theta = model.theta.toArray()
    rows = [
        (float(c), name, float(theta[c, f])) for c in range(theta.shape[0]) for f, name in enumerate(names)
    ]
    return points.sparkSession.createDataFrame(rows, "label double, feature string, theta double")


def tree_description(model: Model, points: DataFrame) -> DataFrame:
    """One row: the fitted tree's depth, node count, rules and feature importances."""
    importances = [float(v) for v in model.featureImportances.toArray()]
    return points.sparkSession.createDataFrame(
        [(model.depth, model.numNodes, model.toDebugString, importances)],
        "depth int, nodes int, rules string, importances array<double>",
    )


def linear_coefficients(model: Model, points: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(label, feature, weight)`` of a logistic regression; the intercept is feature ''."""
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = []
    for c in range(matrix.shape[0]):
        label = float(c) if matrix.shape[0] > 1 else 1.0
        rows.append((label, "", float(intercepts[c])))
        rows += [(label, name, float(matrix[c, f])) for f, name in enumerate(names)]
    return points.sparkSession.createDataFrame(rows, "label double, feature string, weight double")


def scored_columns(scored: DataFrame, *keys: str) -> DataFrame:
    """The part of a scored table that reports need."""
    return scored.select(*keys, F.col("label"), F.col("prediction"))
