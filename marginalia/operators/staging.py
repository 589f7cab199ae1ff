"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="marginalia-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged_path(spark: SparkSession, name: str = "stage") -> str:
    """A new path in the staging folder."""
    return f"{staging_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once as a table and read back: fixed rows, short lineage, pruned reads."""
    path = staged_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, column: str) -> DataFrame:
    """Like ``staged``, dealt by ``column`` as a shuffle would deal it, so that joins on it move only the other side."""
    spark = df.sparkSession
    name = f"stage_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets(spark), column).option("path", staged_path(spark)).saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files stay, like other stages
    return rows
