"""Accuracy and reports over scored tables (``label``, ``prediction`` and usually ``split``)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def correct(scored: DataFrame) -> DataFrame:
    """The rows whose prediction is their label."""
    return scored.filter(F.col("label") == F.col("prediction"))


def _correct_count(prediction: str = "prediction") -> Column:
    right = F.when(F.col("label") == F.col(f"`{prediction}`"), 1).otherwise(0)
    return F.coalesce(F.sum(right), F.lit(0))


def accuracy(scored: DataFrame, *by: str) -> DataFrame:
    """``(*by, n, correct, accuracy)`` in one aggregate.

    A row without label or prediction counts as wrong; an empty table has accuracy NULL.
    """
    counts = scored.groupBy(*by).agg(F.count("*").alias("n"), _correct_count().alias("correct"))
    return counts.withColumn("accuracy", F.try_divide(F.col("correct").cast("double"), F.col("n")))


def confusion(scored: DataFrame, *by: str) -> DataFrame:
    """``(*by, label, prediction, n)``, one row per cell that occurs."""
    return scored.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def report(scored: DataFrame, model: str, dataset: str) -> DataFrame:
    """``(model, dataset, split, accuracy)`` of one scored table."""
    return accuracy(scored, "split").select(
        F.lit(model).alias("model"), F.lit(dataset).alias("dataset"), "split", "accuracy"
    )


def report_all(scored: DataFrame, models: Sequence[str], dataset: str) -> DataFrame:
    """The same for a table with a ``prediction of <model>`` column for each of several models."""
    shares = [
        F.struct(
            F.lit(model).alias("model"),
            F.try_divide(_correct_count(f"prediction of {model}").cast("double"), F.count("*")).alias("accuracy"),
        )
        for model in models
    ]
    rows = scored.groupBy("split").agg(F.array(*shares).alias("shares")).select("split", F.inline("shares"))
    return rows.select("model", F.lit(dataset).alias("dataset"), "split", "accuracy")


def report_lines(reports: DataFrame) -> DataFrame:
    """``(model, dataset, line)``: test and train accuracy of each model as one line of text."""
    by_split = reports.groupBy("model", "dataset").pivot("split", ["test", "train"])
    return by_split.agg(F.first("accuracy")).select(
        "model",
        "dataset",
        F.format_string("accuracy test: %.4f, train: %.4f", F.col("test"), F.col("train")).alias("line"),
    )


def comparison(reports: Sequence[DataFrame], datasets: Sequence[str]) -> DataFrame:
    """``(model, split, <one column per dataset>)``."""
    rows = reduce(DataFrame.unionByName, reports)
    return rows.groupBy("model", "split").pivot("dataset", list(datasets)).agg(F.first("accuracy"))


def area_under_roc(scored: DataFrame, score: str = "rawPrediction", label: str = "label") -> float:
    """Exact area under the ROC curve of a two-class scored table.

    ``score`` is a double or a two-element vector. More than two classes are an error.
    """
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(scored)
