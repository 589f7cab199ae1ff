"""Linear scores, vector sums, Gram products and nearest neighbours over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.vectors import doubles
from marginalia.operators import evaluate, linear, neighbours
from marginalia.operators.split import key_split, one_vs_rest_label, side, signed, two_classes
from marginalia.sources.tables import read_table

WIDTH = 64
WEIGHTS = [(i % 7 - 3) / 4 for i in range(WIDTH)]
BIAS = 0.125
K = 5


def table(spark: SparkSession, folder: str) -> DataFrame:
    """``(vec_id, features array<double>, label double)``."""
    rows = read_table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    return rows.select(
        "vec_id", doubles(F.col("embedding")).alias("features"), F.col("label").cast("double").alias("label")
    )


def linear_margin(spark: SparkSession, folder: str) -> DataFrame:
    scored = linear.linear_score(table(spark, folder), WEIGHTS, BIAS)
    return scored.select("vec_id", F.round("score", 6).alias("score"), "prediction")


def _first_class():
    """+1 for label 0 and -1 for every other label."""
    return signed(one_vs_rest_label(F.col("label"), 0.0))


def weighted_vector_sum(spark: SparkSession, folder: str) -> DataFrame:
    total = linear.weighted_vector_sum(table(spark, folder), (F.col("label") + 1.0) * _first_class())
    return total.select("pos", F.round("total", 6).alias("total"))


def gram_product(spark: SparkSession, folder: str) -> DataFrame:
    coefficient = (F.col("label") + 1.0) * _first_class()
    rows = linear.gram_product(table(spark, folder), coefficient)
    return rows.select("vec_id", F.round("product", 6).alias("product"))


def gram_diagonal(spark: SparkSession, folder: str) -> DataFrame:
    rows = linear.squared_norm(table(spark, folder))
    return rows.select("vec_id", F.round("squared_norm", 6).alias("squared_norm"))


def binarise_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings", "label").select(F.col("label").cast("double").alias("label"))
    reduced = rows.select(one_vs_rest_label(F.col("label"), 3.0).alias("label"))
    return reduced.groupBy("label").agg(F.count("*").alias("n"))


def two_class_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings", "label").select(F.col("label").cast("double").alias("label"))
    return two_classes(rows, 1.0, 3.0).groupBy("label").agg(F.count("*").alias("n"))


def _neighbours(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    split = key_split(table(spark, folder).withColumnRenamed("vec_id", "id"), "id", train_parts=4, parts=5)
    test = side(split, "test")
    return neighbours.nearest(side(split, "train"), test, K), test


def knn_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = _neighbours(spark, folder)
    return found.select("test_id", "rank", "train_id", F.round("distance", 6).alias("distance"))


def knn_predict(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = _neighbours(spark, folder)
    return neighbours.majority(found)


def knn_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    found, test = _neighbours(spark, folder)
    scored = test.select("id", "label").join(neighbours.majority(found), "id", "left")
    return evaluate.accuracy(scored)


QUERIES = {
    "linear_margin": linear_margin,
    "weighted_vector_sum": weighted_vector_sum,
    "gram_product": gram_product,
    "gram_diagonal": gram_diagonal,
    "binarise_counts": binarise_counts,
    "two_class_counts": two_class_counts,
    "knn_neighbours": knn_neighbours,
    "knn_predict": knn_predict,
    "knn_accuracy": knn_accuracy,
}

_ELEMENTS_SQL = """elements AS (
  SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(unnest(embedding) AS DOUBLE) AS v,
         unnest(range(len(embedding))) AS pos
  FROM embeddings
)"""
_COEFFICIENT_SQL = "(label + 1.0) * CASE WHEN label = 0 THEN 1.0 ELSE -1.0 END"
_KNN_SQL = f"""WITH {_ELEMENTS_SQL},
sides AS (
  SELECT vec_id, label,
         CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 < 4 AS train
  FROM embeddings
),
pairs AS (
  SELECT a.vec_id AS test_id, b.vec_id AS train_id, sqrt(sum((a.v - b.v) * (a.v - b.v))) AS distance
  FROM elements a JOIN elements b ON a.pos = b.pos
  WHERE a.vec_id IN (SELECT vec_id FROM sides WHERE NOT train)
    AND b.vec_id IN (SELECT vec_id FROM sides WHERE train)
  GROUP BY a.vec_id, b.vec_id
),
ranked AS (
  SELECT test_id, CAST(row_number() OVER (PARTITION BY test_id ORDER BY distance, train_id) AS INTEGER) AS rank,
         train_id, distance
  FROM pairs QUALIFY row_number() OVER (PARTITION BY test_id ORDER BY distance, train_id) <= {K}
),
votes AS (
  SELECT test_id, CAST(s.label AS DOUBLE) AS label, count(*) AS votes
  FROM ranked JOIN sides s ON s.vec_id = train_id GROUP BY test_id, s.label
),
predicted AS (
  SELECT test_id AS id, label AS prediction FROM votes
  QUALIFY row_number() OVER (PARTITION BY test_id ORDER BY votes DESC, label) = 1
)
"""

ORACLES = {
    "linear_margin": f"""WITH {_ELEMENTS_SQL},
      scores AS (SELECT vec_id, sum(v * ((pos % 7 - 3) / 4.0)) + {BIAS} AS score FROM elements GROUP BY vec_id)
      SELECT vec_id, round(score, 6) AS score, CASE WHEN score > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS prediction FROM scores""",
    "weighted_vector_sum": f"""WITH {_ELEMENTS_SQL}
      SELECT CAST(pos AS INTEGER) AS pos, round(sum(v * {_COEFFICIENT_SQL}), 6) AS total FROM elements GROUP BY pos""",
    "gram_product": f"""WITH {_ELEMENTS_SQL},
      gram AS (
        SELECT a.vec_id AS i, b.vec_id AS j, any_value(b.label) AS label, sum(a.v * b.v) AS g
        FROM elements a JOIN elements b ON a.pos = b.pos GROUP BY a.vec_id, b.vec_id
      )
      SELECT i AS vec_id, round(sum(g * {_COEFFICIENT_SQL}), 6) AS product FROM gram GROUP BY i""",
    "gram_diagonal": f"WITH {_ELEMENTS_SQL} SELECT vec_id, round(sum(v * v), 6) AS squared_norm FROM elements GROUP BY vec_id",
    "binarise_counts": "SELECT CASE WHEN label = 3 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label, count(*) AS n FROM embeddings GROUP BY 1",
    "two_class_counts": "SELECT CASE WHEN label = 3 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label, count(*) AS n FROM embeddings WHERE label IN (1, 3) GROUP BY 1",
    "knn_neighbours": f"{_KNN_SQL} SELECT test_id, rank, train_id, round(distance, 6) AS distance FROM ranked",
    "knn_predict": f"{_KNN_SQL} SELECT id, prediction FROM predicted",
    "knn_accuracy": f"""{_KNN_SQL} SELECT count(*) AS n,
        CAST(sum(CASE WHEN CAST(label AS DOUBLE) = prediction THEN 1 ELSE 0 END) AS BIGINT) AS correct,
        CAST(sum(CASE WHEN CAST(label AS DOUBLE) = prediction THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS accuracy
      FROM sides LEFT JOIN predicted ON id = vec_id WHERE NOT train""",
}
