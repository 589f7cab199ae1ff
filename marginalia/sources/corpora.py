"""Two text files that belong together line by line: sentences and their tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, value)``, counted from 0 in file order (files by path, then by position).

    Each input split counts its own lines, the counts (one row per split) become starting
    numbers, and a line's number is its split's start plus its place in the split. Only a line feed
    ends a line. The lines are not sorted to number them; the join with the starting numbers shuffles them
    unless Spark finds the small side broadcastable.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seen"),
    )
    splits = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("seen").alias("first"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    return lines.join(starts, ["file", "block"]).select(
        (F.col("start") + F.col("seen") - F.col("first")).alias("line_no"), "value"
    )


def read_tagged_corpus(spark: SparkSession, chars_path: str, tags_path: str) -> DataFrame:
    """``(sent_id, chars, tags)``; a missing partner line or an unequal length is an error."""
    chars = numbered_lines(spark, chars_path).withColumnRenamed("value", "chars")
    tags = numbered_lines(spark, tags_path).withColumnRenamed("value", "tags")
    both = chars.join(tags, "line_no", "full_outer")
    aligned = F.coalesce(F.char_length("chars") == F.char_length("tags"), F.lit(False))
    message = F.concat(F.lit("line without equally long partner: "), F.col("line_no").cast("string"))
    return both.select(
        F.col("line_no").alias("sent_id"),
        F.when(aligned, F.col("chars")).otherwise(F.raise_error(message).cast("string")).alias("chars"),
        "tags",
    )
