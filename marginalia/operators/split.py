"""Train/test splits, samples and class reduction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.keys import key_bucket


def key_split(
    df: DataFrame, key: str, train_parts: int = 3, parts: int = 4, hashed: bool = True
) -> DataFrame:
    """Add ``split``: 'train' for ``train_parts`` of ``parts`` key buckets, 'test' for the rest.

    The same key always falls on the same side, whatever the partitioning, and no row is moved.
    """
    train = key_bucket(F.col(key), parts, hashed) < train_parts
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def side(df: DataFrame, name: str) -> DataFrame:
    """One side of a split table, without the ``split`` column."""
    return df.filter(F.col("split") == name).drop("split")


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random split by weights. Repeatable only for the same partitioning; see ``key_split``."""
    return df.randomSplit(list(weights), seed=seed)


def key_sample(df: DataFrame, key: str, parts: int, of: int, hashed: bool = True) -> DataFrame:
    """The rows whose key falls in the first ``parts`` of ``of`` buckets."""
    return df.filter(key_bucket(F.col(key), of, hashed) < parts)


def random_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """A Bernoulli sample of rows."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def one_vs_rest_label(label: Column, positive: float) -> Column:
    """1.0 for the chosen class and 0.0 for every other one."""
    return F.when(label == F.lit(positive), F.lit(1.0)).otherwise(F.lit(0.0))


def two_classes(df: DataFrame, negative: float, positive: float, label: str = "label") -> DataFrame:
    """Only the rows of two classes, relabelled 0.0 and 1.0."""
    pair = df.filter(F.col(label).isin(negative, positive))
    return pair.withColumn(label, one_vs_rest_label(F.col(label), positive))


def signed(label: Column) -> Column:
    """0/1 labels as -1/+1."""
    return F.when(label > 0, F.lit(1.0)).otherwise(F.lit(-1.0))
