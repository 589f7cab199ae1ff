"""Linear scores, weighted vector sums and products with the Gram matrix.

Tables carry ``features array<double>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.vectors import (
    checked,
    dot,
    dot_constant,
    weighted_sum,
    weighted_totals,
    width_of,
)


def linear_score(df: DataFrame, weights: Sequence[float], bias: float) -> DataFrame:
    """Add ``score`` = w.x + b and ``prediction``, 1.0 above zero and -1.0 otherwise."""
    features = checked(F.col("features"), len(weights))
    scored = df.withColumn("score", dot_constant(features, weights) + F.lit(float(bias)))
    return scored.withColumn("prediction", F.when(F.col("score") > 0, 1.0).otherwise(-1.0))


def margin(features: Column, label: Column, weights: Sequence[float], bias: float) -> Column:
    """y (w.x + b), positive exactly where the row is on the right side."""
    return label * (dot_constant(features, weights) + F.lit(float(bias)))


def weighted_vector_sum(df: DataFrame, weight: Column) -> DataFrame:
    """``(pos, total)``: the sum of weight * features over all rows, one row per element."""
    width = width_of(df)
    totals = weighted_totals(df, checked(F.col("features"), width), weight, width)
    return totals.filter(F.col("pos") < width)


def gram_product(df: DataFrame, coefficient: Column, output: str = "product") -> DataFrame:
    """Add the row of the Gram matrix times the coefficients: sum over j of c_j (x_i . x_j).

    The n x n matrix is never formed: the weighted sum of all rows comes first (one
    vector), then every row takes its inner product with it.
    """
    width = width_of(df)
    features = checked(F.col("features"), width)
    total, _, _ = weighted_sum(df, features, coefficient, width)
    return df.withColumn(output, dot_constant(features, total))


def gram_columns(df: DataFrame, landmarks: Sequence[Sequence[float]], output: str = "gram") -> DataFrame:
    """Add the row's inner products with each landmark vector, as ``array<double>``.

    With rows of the table as landmarks these are columns of the Gram matrix. Landmarks are
    driver literals, so their number is the caller's choice and the output has one row per row.
    """
    features = checked(F.col("features"), len(landmarks[0]))
    return df.withColumn(output, F.array(*[dot_constant(features, v) for v in landmarks]))


def squared_norm(df: DataFrame, output: str = "squared_norm") -> DataFrame:
    """Add x.x, the diagonal of the Gram matrix."""
    return df.withColumn(output, dot(F.col("features"), F.col("features")))
