"""Samples of an exact size: the rows whose keys have the smallest hashes.

Every task keeps its smallest rows and the kept ones are merged, so no table is sorted as a whole; a class keeps its own.
The sample depends on keys and seed only, not on partitions, and the samples of two tables merge into that of both.
A null key counts as the empty string. Rows with equal keys are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_order(key: str, seed: int = 0) -> list[Column]:
    """What rows are ordered by: the MD5 of seed and key, then the key."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return [F.md5(F.concat(F.lit(f"{seed}:"), text)), text]


def exact_sample(df: DataFrame, key: str, rows: int, seed: int = 0) -> DataFrame:
    """``rows`` rows of ``df``, or all if there are fewer."""
    return df.orderBy(*key_order(key, seed)).limit(rows)


def exact_sample_by(df: DataFrame, key: str, rows: int, by: str, seed: int = 0) -> DataFrame:
    """``rows`` rows of each value of ``by``, null included, or all it has if they are fewer."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(*key_order(key, seed)))
    columns = [df[c] for c in df.columns]
    ranked = df.select(F.struct(*columns).alias("row"), place.alias("place"))
    return ranked.filter(F.col("place") <= rows).select("row.*")
