"""The perceptron on ``lineitem``, ``part`` and ``embeddings``.

Labels of the first two are a fixed linear rule, so that all sums are over whole numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.vectors import doubles
from marginalia.operators import perceptron
from marginalia.operators.split import one_vs_rest_label, signed
from marginalia.sources.tables import read_table

EPOCHS = 8
#: Shards of the query that SQL follows row by row: a power of two, so that few epochs' means are exact.
SHARDS, SHARD_EPOCHS = 64, 4


def line_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``(features, label)``: line number and quantity; +1 where quantity + 3 * line number > 40."""
    lines = read_table(spark, folder, "lineitem", "l_linenumber", "l_quantity")
    x1, x2 = F.col("l_linenumber").cast("double"), F.col("l_quantity")
    return lines.select(F.array(x1, x2).alias("features"), _sign(x2 + 3 * x1 > 40).alias("label"))


def part_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, features, label)``: size and key modulo 7; +1 where size + 3 * remainder > 40."""
    parts = read_table(spark, folder, "part", "p_partkey", "p_size").toDF("id", "size")
    x1, x2 = F.col("size").cast("double"), F.pmod("id", F.lit(7)).cast("double")
    return parts.select("id", F.array(x1, x2).alias("features"), _sign(x1 + 3 * x2 > 40).alias("label"))


def sharded_part_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``part_rows`` with the shard that visits each row: the remainder of its key."""
    return part_rows(spark, folder).withColumn("shard", F.pmod("id", F.lit(SHARDS)))


def embedding_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, features, label)``: +1 for label 0."""
    rows = read_table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    label = signed(one_vs_rest_label(F.col("label"), 0))
    return rows.select(
        F.col("vec_id").alias("id"), doubles(F.col("embedding")).alias("features"), label.alias("label")
    )


def _sign(condition):
    return F.when(condition, 1.0).otherwise(-1.0)


def _pair(df: DataFrame) -> DataFrame:
    """Two weights as columns instead of an array."""
    first, second = F.get("weights", F.lit(0)).alias("w1"), F.get("weights", F.lit(1)).alias("w2")
    return df.select(*[c for c in df.columns if c != "weights"], first, second)


def perceptron_points(spark: SparkSession, folder: str) -> DataFrame:
    rows = part_rows(spark, folder)
    return rows.select(
        "id", F.get("features", F.lit(0)).alias("x1"), F.get("features", F.lit(1)).alias("x2"), "label"
    )


def perceptron_batch_log(spark: SparkSession, folder: str) -> DataFrame:
    fit = perceptron.perceptron_fit(line_rows(spark, folder), max_epochs=EPOCHS)
    return _pair(perceptron.epoch_log(spark, fit))


def perceptron_batch_model(spark: SparkSession, folder: str) -> DataFrame:
    fit = perceptron.perceptron_fit(line_rows(spark, folder), max_epochs=EPOCHS)
    return _pair(perceptron.model_table(spark, fit))


def perceptron_dual_alpha(spark: SparkSession, folder: str) -> DataFrame:
    rows = part_rows(spark, folder)
    fit = perceptron.perceptron_fit(rows, max_epochs=EPOCHS)
    return perceptron.perceptron_alpha(rows, fit).select("id", "alpha")


def perceptron_dual_model(spark: SparkSession, folder: str) -> DataFrame:
    rows = part_rows(spark, folder)
    fit = perceptron.perceptron_fit(rows, max_epochs=EPOCHS)
    return _pair(perceptron.dual_model(perceptron.perceptron_alpha(rows, fit), fit))


def perceptron_mixing_log(spark: SparkSession, folder: str) -> DataFrame:
    fit = perceptron.perceptron_fit(embedding_rows(spark, folder), "mixing", max_epochs=EPOCHS, shards=4)
    return perceptron.epoch_log(spark, fit)


def perceptron_mixing_alpha(spark: SparkSession, folder: str) -> DataFrame:
    rows = embedding_rows(spark, folder)
    fit = perceptron.perceptron_fit(rows, "mixing", max_epochs=EPOCHS, shards=4)
    return perceptron.perceptron_alpha(rows, fit).select("id", "alpha")


def perceptron_visits(spark: SparkSession, folder: str) -> DataFrame:
    rows = embedding_rows(spark, folder)
    fit = perceptron.perceptron_fit(rows, "mixing", max_epochs=EPOCHS, shards=4)
    return perceptron.visit_log(rows, fit)


def perceptron_shards_log(spark: SparkSession, folder: str) -> DataFrame:
    """Epochs of training shard by shard, each visiting its rows in order of their keys."""
    rows = sharded_part_rows(spark, folder)
    return _pair(perceptron.epoch_log(spark, perceptron.perceptron_fit(rows, "mixing", max_epochs=SHARD_EPOCHS, shards=SHARDS)))


def perceptron_shards_alpha(spark: SparkSession, folder: str) -> DataFrame:
    """In how many of those epochs each row was a mistake."""
    rows = sharded_part_rows(spark, folder)
    fit = perceptron.perceptron_fit(rows, "mixing", max_epochs=SHARD_EPOCHS, shards=SHARDS)
    return perceptron.perceptron_alpha(rows, fit).select("id", "alpha")


def perceptron_shards_visits(spark: SparkSession, folder: str) -> DataFrame:
    """Margin of every row at each of its visits."""
    rows = sharded_part_rows(spark, folder)
    fit = perceptron.perceptron_fit(rows, "mixing", max_epochs=SHARD_EPOCHS, shards=SHARDS)
    return perceptron.visit_log(rows, fit)


QUERIES = {
    "perceptron_points": perceptron_points,
    "perceptron_batch_log": perceptron_batch_log,
    "perceptron_batch_model": perceptron_batch_model,
    "perceptron_dual_alpha": perceptron_dual_alpha,
    "perceptron_dual_model": perceptron_dual_model,
    "perceptron_mixing_log": perceptron_mixing_log,
    "perceptron_mixing_alpha": perceptron_mixing_alpha,
    "perceptron_visits": perceptron_visits,
    "perceptron_shards_log": perceptron_shards_log,
    "perceptron_shards_alpha": perceptron_shards_alpha,
    "perceptron_shards_visits": perceptron_shards_visits,
}

_LINES_SQL = """points AS (
  SELECT CAST(l_linenumber AS DOUBLE) AS x1, l_quantity AS x2,
         CASE WHEN l_quantity + 3 * l_linenumber > 40 THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS y
  FROM lineitem
)"""
_PARTS_SQL = """points AS (
  SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x1, CAST(p_partkey % 7 AS DOUBLE) AS x2,
         CASE WHEN p_size + 3 * (p_partkey % 7) > 40 THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS y
  FROM part
)"""
_STEPS_SQL = f"""steps AS (
  SELECT 0 AS epoch, CAST(0 AS BIGINT) AS mistakes, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2, CAST(0 AS DOUBLE) AS bias
  UNION ALL
  SELECT epoch + 1, found.mistakes, w1 + found.d1, w2 + found.d2, bias + found.db
  FROM steps, LATERAL (
    SELECT count(*) AS mistakes, coalesce(sum(y * x1), 0) AS d1, coalesce(sum(y * x2), 0) AS d2, coalesce(sum(y), 0) AS db
    FROM points WHERE y * (w1 * x1 + w2 * x2 + bias) <= 0
  ) AS found
  WHERE epoch < {EPOCHS} AND (epoch = 0 OR steps.mistakes > 0)
)"""
_ALPHA_SQL = f"""WITH RECURSIVE {_PARTS_SQL}, {_STEPS_SQL},
starts AS (SELECT * FROM steps WHERE epoch < (SELECT max(epoch) FROM steps)),
alphas AS (
  SELECT id, x1, x2, y, count(*) FILTER (WHERE y * (w1 * x1 + w2 * x2 + bias) <= 0) AS alpha
  FROM points CROSS JOIN starts GROUP BY id, x1, x2, y
)"""


def _shards_sql() -> str:
    """``sK``: the visits of epoch K + 1 in turn, with the shard's weights after each; ``mK``: the mean weights after K epochs."""
    ctes = [
        f"""{_PARTS_SQL},
placed AS MATERIALIZED (
  SELECT *, id % {SHARDS} AS shard, row_number() OVER (PARTITION BY id % {SHARDS} ORDER BY id) AS turn FROM points
),
m0 AS (SELECT CAST(1 AS BIGINT) AS mistakes, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2, CAST(0 AS DOUBLE) AS bias)"""
    ]
    for k in range(SHARD_EPOCHS):
        ctes.append(
            f"""s{k} AS (
  SELECT DISTINCT shard, CAST(0 AS BIGINT) AS turn, CAST(NULL AS BIGINT) AS id, CAST(NULL AS DOUBLE) AS margin, w1, w2, bias FROM placed, m{k}
  UNION ALL
  SELECT shard, turn, id, margin, w1 + gain * x1, w2 + gain * x2, bias + gain FROM (
    SELECT *, CASE WHEN margin <= 0 THEN y ELSE 0 END AS gain FROM (
      SELECT p.shard, p.turn, p.id, p.x1, p.x2, p.y, w1, w2, bias, p.y * (w1 * p.x1 + w2 * p.x2 + bias) AS margin
      FROM s{k} s JOIN placed p ON p.shard = s.shard AND p.turn = s.turn + 1))
),
m{k + 1} AS MATERIALIZED (
  SELECT CAST(sum(wrong) AS BIGINT) AS mistakes, sum(w1) / count(*) AS w1, sum(w2) / count(*) AS w2, sum(bias) / count(*) AS bias
  FROM (SELECT shard, count(*) FILTER (WHERE margin <= 0) AS wrong, arg_max(w1, turn) AS w1, arg_max(w2, turn) AS w2,
               arg_max(bias, turn) AS bias FROM s{k} GROUP BY shard)
)"""
        )
    log = " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS epoch, * FROM m{k}" for k in range(1, SHARD_EPOCHS + 1))
    ctes.append(f"every AS ({log})")
    ctes.append("epochs AS (SELECT * FROM every WHERE epoch <= coalesce((SELECT min(epoch) FROM every WHERE mistakes = 0), epoch))")
    seen = " UNION ALL ".join(f"SELECT CAST({k + 1} AS INTEGER) AS epoch, id, margin FROM s{k} WHERE turn > 0" for k in range(SHARD_EPOCHS))
    ctes.append(f"visits AS (SELECT * FROM ({seen}) WHERE epoch IN (SELECT epoch FROM epochs))")
    return "WITH RECURSIVE " + ",\n".join(ctes)


ORACLES = {
    "perceptron_points": f"WITH {_PARTS_SQL} SELECT id, x1, x2, y AS label FROM points",
    "perceptron_batch_log": f"WITH RECURSIVE {_LINES_SQL}, {_STEPS_SQL} SELECT epoch, mistakes, w1, w2, bias FROM steps WHERE epoch > 0",
    "perceptron_batch_model": f"""WITH RECURSIVE {_LINES_SQL}, {_STEPS_SQL}
      SELECT w1, w2, bias, epoch AS epochs, mistakes = 0 AS converged FROM steps ORDER BY epoch DESC LIMIT 1""",
    "perceptron_dual_alpha": f"{_ALPHA_SQL} SELECT id, alpha FROM alphas",
    "perceptron_dual_model": f"{_ALPHA_SQL} SELECT sum(alpha * y * x1) AS w1, sum(alpha * y * x2) AS w2, sum(alpha * y) AS bias FROM alphas",
    "perceptron_shards_log": f"{_shards_sql()} SELECT epoch, mistakes, w1, w2, bias FROM epochs",
    "perceptron_shards_alpha": f"{_shards_sql()} SELECT id, count(*) FILTER (WHERE margin <= 0) AS alpha FROM visits GROUP BY id",
    "perceptron_shards_visits": f"{_shards_sql()} SELECT epoch, id, margin, margin <= 0 AS mistake FROM visits",
}
