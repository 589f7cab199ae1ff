"""A grid of logistic regressions for English or not, trained together; a certificate of the L1 solution."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.keys import hash_bucket
from marginalia.functions.text import letter_counts
from marginalia.operators import proximal
from marginalia.operators.staging import staged
from marginalia.plans.language import _COUNTS_SQL, COUNTS, LETTERS
from marginalia.plans.models import _bucket_sql
from marginalia.sources.tables import read_table, spread

TARGET = "en"
DIGITS = 6
GRID = proximal.grid()
#: For the certificate: the steps end where its conditions hold that closely.
STEPS, TOLERANCE = 60, 5e-3


def english_points(spark: SparkSession, folder: str) -> DataFrame:
    """``(label, split, letter counts)`` of the documents that train; of those, one key in five validates."""
    documents = read_table(spark, folder, "documents", "doc_id", "text", "lang").filter(F.pmod("doc_id", F.lit(4)) < 3)
    label = (F.col("lang") == TARGET).cast("double").alias("label")
    split = F.when(hash_bucket(F.col("doc_id"), 5) < 4, "train").otherwise("validation").alias("split")
    return staged(spread(documents, "doc_id").select(label, split, *letter_counts(F.col("text"), LETTERS)))


def shared_search(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = proximal.search(english_points(spark, folder), COUNTS, GRID)
    return found.withColumn("area", F.round("area", DIGITS))


def shared_search_best(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = proximal.search(english_points(spark, folder), COUNTS, GRID)
    return proximal.best(found, DIGITS)


def l1_certificate(spark: SparkSession, folder: str) -> DataFrame:
    """Weights, gradients and how far the optimality conditions are off, for two L1 penalties."""
    points = english_points(spark, folder)
    settings = proximal.grid((0.001, 0.01), (True,), (STEPS,), (1.0,))
    return proximal.certificate(points, proximal.fit_all(points, COUNTS, settings, TOLERANCE))


QUERIES = {"shared_search": shared_search, "shared_search_best": shared_search_best}


def _search_sql() -> str:
    """The same steps: ``wK`` and ``yK`` hold weights and look-ahead weights of all settings after K steps."""
    last, one = len(COUNTS), float(1 << proximal.GRADIENT_BITS)
    grid = ", ".join(
        f"({k}, {s.reg_param!r}::DOUBLE, {str(s.fit_intercept).lower()}, {s.max_iter}, {s.elastic_net!r}::DOUBLE, {s.lasso!r}::DOUBLE, {s.ridge!r}::DOUBLE)"
        for k, s in enumerate(GRID)
    )
    places = "CASE feature " + " ".join(f"WHEN '{c}' THEN {k}" for k, c in enumerate(COUNTS)) + " END"
    ctes = [
        f"""points AS MATERIALIZED (
            SELECT doc_id, CASE WHEN lang = '{TARGET}' THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
                   {_bucket_sql('doc_id', 5)} < 4 AS train, {_COUNTS_SQL}
            FROM documents WHERE doc_id % 4 < 3),
        raw AS (SELECT doc_id, label, train, {places} AS j, x FROM (UNPIVOT points ON {", ".join(COUNTS)} INTO NAME feature VALUE x)),
        moments AS MATERIALIZED (
            SELECT j, sum(x) / count(*) AS mean, sqrt(sum(x * x) / count(*) - (sum(x) / count(*)) * (sum(x) / count(*))) AS sd, count(*) AS n
            FROM raw WHERE train GROUP BY j),
        cells AS MATERIALIZED (
            SELECT doc_id, label, train, c AS fit_intercept, j, x / sd - CASE WHEN c THEN mean / sd ELSE 0.0::DOUBLE END AS x
            FROM raw JOIN moments USING (j), (VALUES (true), (false)) v(c)
            UNION ALL SELECT doc_id, label, train, true, {last}, 1.0::DOUBLE FROM points),
        settings(setting, reg_param, fit_intercept, max_iter, elastic_net, lasso, ridge) AS (VALUES {grid}),
        rates AS MATERIALIZED (
            SELECT *, 1.0 / (0.25 * CASE WHEN fit_intercept THEN {last + 1}
                ELSE (SELECT sum((sd * sd + mean * mean) / (sd * sd)) FROM moments) END + ridge) AS rate,
                (SELECT max(n) FROM moments) AS n
            FROM settings),
        w0 AS (
            SELECT setting, j, 0.0::DOUBLE AS w, 0.0::DOUBLE AS y FROM settings, range({last + 1}) r(j) WHERE fit_intercept OR j < {last})"""
    ]
    pace = 1.0
    for k in range(GRID[0].max_iter):
        following = (1.0 + math.sqrt(1.0 + 4.0 * pace * pace)) / 2.0
        ctes.append(
            f"""m{k} AS MATERIALIZED (
            SELECT setting, doc_id, 1.0 / (1.0 + exp(-sum(x * y))) - any_value(label) AS error
            FROM w{k} JOIN settings USING (setting) JOIN cells USING (fit_intercept, j) WHERE train GROUP BY ALL),
        g{k} AS MATERIALIZED (
            SELECT setting, j, sum(CAST(floor(x * error * {one!r}::DOUBLE + 0.5) AS BIGINT))::DOUBLE / {one!r}::DOUBLE AS total
            FROM m{k} JOIN settings USING (setting) JOIN cells USING (fit_intercept, doc_id) GROUP BY ALL),
        v{k} AS (
            SELECT setting, j, w AS before, y - rate * (total / n + CASE WHEN j < {last} THEN ridge ELSE 0.0 END * y) AS v,
                   CASE WHEN j < {last} THEN rate * lasso ELSE 0.0 END AS cut
            FROM w{k} JOIN g{k} USING (setting, j) JOIN rates USING (setting)),
        w{k + 1} AS MATERIALIZED (
            SELECT setting, j, sign(v) * greatest(abs(v) - cut, 0.0) AS w,
                   sign(v) * greatest(abs(v) - cut, 0.0) + {(pace - 1.0) / following!r}::DOUBLE * (sign(v) * greatest(abs(v) - cut, 0.0) - before) AS y
            FROM v{k})"""
        )
        pace = following
    steps = GRID[0].max_iter
    ctes.append(
        f"""scored AS (
            SELECT setting, doc_id, any_value(label) AS label, floor(sum(x * w) * {float(1 << proximal.SCORE_BITS)!r}::DOUBLE + 0.5) AS score
            FROM w{steps} JOIN settings USING (setting) JOIN cells USING (fit_intercept, j) WHERE NOT train GROUP BY setting, doc_id),
        ranked AS (
            SELECT *, rank() OVER (PARTITION BY setting ORDER BY score) + (count(*) OVER (PARTITION BY setting, score) - 1) / 2.0 AS place FROM scored),
        areas AS (
            SELECT setting, round((sum(place) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
                / (count(*) FILTER (WHERE label = 1) * CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE)), {DIGITS}) AS area
            FROM ranked GROUP BY setting)"""
    )
    return "WITH " + ",\n".join(ctes)


ORACLES = {
    "shared_search": f"""{_search_sql()}
      SELECT setting, reg_param, fit_intercept, max_iter, elastic_net, area FROM settings JOIN areas USING (setting)""",
    "shared_search_best": f"""{_search_sql()},
      first AS (SELECT * FROM settings JOIN areas USING (setting) ORDER BY area DESC, setting LIMIT 1)
      SELECT 'reg_param' AS param, CAST(reg_param AS DOUBLE) AS value FROM first
      UNION ALL SELECT 'fit_intercept', CAST(fit_intercept AS DOUBLE) FROM first
      UNION ALL SELECT 'max_iter', CAST(max_iter AS DOUBLE) FROM first
      UNION ALL SELECT 'elastic_net', CAST(elastic_net AS DOUBLE) FROM first""",
}
QUERIES["l1_certificate"] = l1_certificate
