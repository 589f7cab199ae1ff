"""Labelled points: tables with a ``label`` double and a ``features`` vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A class column with more values than this is taken for a mistake.
MAX_CLASSES = 10_000


def read_measurements(
    spark: SparkSession, path: str, numbers: Sequence[str], name: str = "species"
) -> DataFrame:
    """A headerless CSV file: one number per column of ``numbers``, then a class name."""
    fields = [T.StructField(column, T.DoubleType()) for column in numbers]
    schema = T.StructType([*fields, T.StructField(name, T.StringType())])
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path)


def label_names(df: DataFrame, class_column: str) -> list[str]:
    """The class names in label order (alphabetical): the name at i has label i.

    Only the names reach the driver, and no more than ``MAX_CLASSES`` of them.
    """
    return [name for name, _ in _class_counts(df, class_column)]


def label_index(df: DataFrame, class_column: str) -> DataFrame:
    """``(name, label, n)`` for every class of ``df``."""
    rows = [(name, float(i), n) for i, (name, n) in enumerate(_class_counts(df, class_column))]
    return df.sparkSession.createDataFrame(rows, "name string, label double, n bigint")


def _class_counts(df: DataFrame, class_column: str) -> list[tuple[str, int]]:
    known = df.filter(F.col(class_column).isNotNull())
    counts = known.groupBy(F.col(class_column).alias("name")).agg(F.count("*").alias("n"))
    found = counts.limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{class_column} has more than {MAX_CLASSES} values; it is not a class column")
    return sorted((row["name"], row["n"]) for row in found)


def with_label(df: DataFrame, class_column: str, names: Sequence[str] | None = None) -> DataFrame:
    """Add ``label``, the alphabetical index of the class name.

    ``names`` fixes the order and saves the pass that finds the classes. A class outside of it,
    or a missing class, is an error.
    """
    if names is None:
        names = label_names(df, class_column)
    position = _position(F.col(class_column), names)
    unknown = F.raise_error(F.concat(F.lit("unknown class: "), F.coalesce(class_column, F.lit("null"))))
    return df.withColumn("label", F.when(position < 0, unknown.cast("double")).otherwise(position))


def with_features(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Add the vector of ``columns``; a missing value is an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def inline_points(spark: SparkSession, rows: Sequence[tuple[float, Sequence[float]]]) -> DataFrame:
    """A small literal sample of ``(label, features)`` rows as a labelled-point table."""
    schema = "label double, numbers array<double>"
    table = spark.createDataFrame([(float(y), [float(v) for v in x]) for y, x in rows], schema)
    return table.select("label", array_to_vector("numbers").alias("features"))


def inline_documents(spark: SparkSession, sentences: Sequence[str]) -> DataFrame:
    """A small literal list of sentences as a one-column table ``text array<string>``."""
    from marginalia.functions.text import space_tokens

    table = spark.createDataFrame([(s,) for s in sentences], "sentence string")
    return table.select(space_tokens(F.col("sentence")).alias("text"))


def _position(name, names: Sequence[str]):
    ordered = F.array(*[F.lit(n) for n in names])
    return (F.coalesce(F.array_position(ordered, name), F.lit(0)) - 1).cast("double")
