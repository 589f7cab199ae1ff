"""Hyper-parameter search on one train/validation split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame

from marginalia.operators.estimators import logistic_regression, training_rows


def logistic_grid(
    estimator,
    reg_params: Sequence[float] = (0.0001, 0.01, 1.0),
    intercepts: Sequence[bool] = (True, False),
    max_iters: Sequence[int] = (10,),
    elastic_nets: Sequence[float] = (0.1, 0.5, 1.0),
) -> list[dict]:
    """Every combination of the given settings; 18 by default."""
    return (
        ParamGridBuilder()
        .addGrid(estimator.regParam, list(reg_params))
        .addGrid(estimator.fitIntercept, list(intercepts))
        .addGrid(estimator.maxIter, list(max_iters))
        .addGrid(estimator.elasticNetParam, list(elastic_nets))
        .build()
    )


def search(
    train: DataFrame,
    estimator=None,
    grid: list[dict] | None = None,
    evaluator: Evaluator | None = None,
    train_ratio: float = 0.8,
    parallelism: int = 4,
    seed: int = 1,
) -> TrainValidationSplitModel:
    """Fit every setting on ``train_ratio`` of the rows, score it on the rest, refit the best on all.

    The default evaluator is the area under the ROC curve, for two classes.
    """
    estimator = estimator or logistic_regression()
    validation = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=grid or logistic_grid(estimator),
        evaluator=evaluator or BinaryClassificationEvaluator(),
        trainRatio=train_ratio,
        parallelism=parallelism,
        seed=seed,
    )
    with training_rows(train) as rows:
        return validation.fit(rows)


def search_results(model: TrainValidationSplitModel, points: DataFrame) -> DataFrame:
    """``(setting, param, value, metric)``: every parameter of every setting tried, with its score."""
    rows = [
        (number, param.name, str(value), float(metric))
        for number, (setting, metric) in enumerate(zip(model.getEstimatorParamMaps(), model.validationMetrics))
        for param, value in setting.items()
    ]
    schema = "setting int, param string, value string, metric double"
    return points.sparkSession.createDataFrame(rows, schema)


def best_parameters(model: TrainValidationSplitModel, points: DataFrame) -> DataFrame:
    """``(param, value)`` of the best model."""
    settings = model.bestModel.extractParamMap()
    rows = [(param.name, str(value)) for param, value in settings.items()]
    return points.sparkSession.createDataFrame(rows, "param string, value string")
