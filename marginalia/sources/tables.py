"""Parquet tables, read with only the columns a query needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The parquet table ``name`` under ``folder``; ``columns`` bounds what the scan reads."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return table.select(*columns) if columns else table


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """``table`` over all cores, by hash of ``keys`` if any, when it has fewer splits than there are cores.

    For tables straight from small files, before heavy work per row. Large inputs have more splits
    than the cluster has cores and pass through unchanged, without a shuffle.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, *keys) if table.rdd.getNumPartitions() < cores else table
