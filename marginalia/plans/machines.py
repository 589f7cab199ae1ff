"""Support vector machines for the language of a document, by block dual ascent, and how good they are proven to be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.text import letter_counts
from marginalia.operators import dual_svm
from marginalia.operators.staging import staged
from marginalia.plans.language import COUNTS, LETTERS
from marginalia.plans.models import _bucket_sql
from marginalia.sources.labelled import label_names
from marginalia.sources.tables import read_table, spread

REG = 0.01
TOLERANCE = 1e-2
DIGITS = 6
#: Two rounds over small blocks, which SQL can follow row by row.
ROUNDS, BLOCK_ROWS = 2, 64


def shares(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, features, label, split)``: ten times each letter's share of the twelve, the language, three of four train."""
    documents = read_table(spark, folder, "documents", "doc_id", "text", "lang")
    counted = spread(documents, "doc_id").select("doc_id", "lang", *letter_counts(F.col("text"), LETTERS))
    whole = sum(map(F.col, COUNTS[1:]), F.col(COUNTS[0]))
    share = [F.coalesce(F.try_divide(10.0 * F.col(c), whole), F.lit(0.0)) for c in COUNTS]
    split = F.when(F.pmod("doc_id", F.lit(4)) < 3, "train").otherwise("test").alias("split")
    return staged(counted.select(F.col("doc_id").alias("id"), F.array(*share).alias("features"), F.col("lang").alias("label"), split))


def _training(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[str]]:
    rows = shares(spark, folder)
    return rows, rows.filter("split = 'train'"), label_names(rows, "label")


def svm_dual_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Primal and dual values of the first rounds."""
    _, train, names = _training(spark, folder)
    fitted = dual_svm.fit(train, names, REG, 0.0, ROUNDS, BLOCK_ROWS)
    values = [F.round(c, DIGITS).alias(c) for c in ("primal", "dual", "gap")]
    return dual_svm.round_log(train, fitted).select("round", "class", *values)


def svm_dual_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Weights after the first rounds."""
    _, train, names = _training(spark, folder)
    fitted = dual_svm.fit(train, names, REG, 0.0, ROUNDS, BLOCK_ROWS)
    return dual_svm.weight_table(train, fitted, LETTERS).withColumn("weight", F.round("weight", DIGITS))


def svm_certificate(spark: SparkSession, folder: str) -> DataFrame:
    """By class, primal and dual value at the end of training and on how many rows the machine rests."""
    _, train, names = _training(spark, folder)
    fitted = dual_svm.fit(train, names, REG, TOLERANCE)
    last = dual_svm.round_log(train, fitted).filter(F.col("round") == fitted.rounds[-1].number)
    support = dual_svm.duals(fitted).groupBy("class").agg(F.count("*").alias("n_support"))
    return last.join(support, "class", "left").fillna(0, ["n_support"])


def svm_dual_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of the trained machines by split."""
    rows, train, names = _training(spark, folder)
    fitted = dual_svm.fit(train, names, REG, TOLERANCE)
    right = F.count(F.when(F.col("label") == dual_svm.prediction(F.col("features"), fitted), 1))
    return rows.groupBy("split").agg(F.count("*").alias("n"), right.alias("correct"))


QUERIES = {
    "svm_dual_rounds": svm_dual_rounds,
    "svm_dual_weights": svm_dual_weights,
    "svm_certificate": svm_certificate,
    "svm_dual_accuracy": svm_dual_accuracy,
}

_WIDTH = len(COUNTS) + 1


def _rounds_sql() -> str:
    """``wK``, ``aK``: weights and dual variables after K rounds; ``vK``: what they are worth."""
    counts = ", ".join(f"CAST(length(text) - length(replace(text, '{x}', '')) AS DOUBLE) AS {c}" for x, c in zip(LETTERS, COUNTS))
    xs = ", ".join(f"coalesce(10.0::DOUBLE * {c} / nullif({' + '.join(COUNTS)}, 0), 0.0::DOUBLE)" for c in COUNTS)
    one = f"{float(1 << dual_svm.SUM_BITS)!r}::DOUBLE"
    ctes = [
        f"""counted AS (SELECT doc_id, lang, {counts} FROM documents WHERE doc_id % 4 < 3),
        sized AS (SELECT count(*) AS n, CAST(ceil(count(*) / {BLOCK_ROWS}.0) AS BIGINT) AS k, {REG}::DOUBLE * count(*) AS scale FROM counted),
        classes AS (SELECT DISTINCT lang AS class FROM documents WHERE lang IS NOT NULL),
        points AS MATERIALIZED (SELECT doc_id, lang, {_bucket_sql('doc_id', 1 << 40)} % k AS block, [{xs}, 1.0::DOUBLE] AS x, n, k, scale FROM counted, sized),
        placed AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY block ORDER BY doc_id) AS pos, list_dot_product(x, x) AS square FROM points),
        pairs AS MATERIALIZED (
            SELECT p.*, class, CASE WHEN lang = class THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y FROM placed p, classes),
        w0 AS MATERIALIZED (SELECT class, list_transform(range({_WIDTH}), lambda j: 0.0::DOUBLE) AS w FROM classes),
        a0 AS MATERIALIZED (SELECT doc_id, class, 0.0::DOUBLE AS alpha FROM pairs)"""
    ]
    for r in range(ROUNDS):
        ctes.append(
            f"""s{r} AS (
            SELECT DISTINCT block, class, CAST(0 AS BIGINT) AS pos, CAST(NULL AS BIGINT) AS doc_id, 0.0::DOUBLE AS alpha, w
            FROM placed, w{r}
            UNION ALL
            SELECT block, class, pos, doc_id, wanted, list_transform(range(1, {_WIDTH + 1}), lambda j: w[j] + (wanted - alpha) * y * k / scale * x[j])
            FROM (
                SELECT p.block, p.class, p.pos, p.doc_id, a.alpha, s.w, p.x, p.y, p.k, p.scale,
                       greatest(0.0, least(1.0, a.alpha + (1.0 - p.y * list_dot_product(s.w, p.x)) * p.scale / (p.k * p.square))) AS wanted
                FROM s{r} s JOIN pairs p ON p.block = s.block AND p.class = s.class AND p.pos = s.pos + 1
                JOIN a{r} a ON a.doc_id = p.doc_id AND a.class = p.class)),
        a{r + 1} AS MATERIALIZED (SELECT doc_id, class, alpha FROM s{r} WHERE pos > 0),
        w{r + 1} AS MATERIALIZED (
            SELECT class, list(v ORDER BY j) AS w FROM (
                SELECT class, j, sum(part) / any_value(scale) AS v FROM (
                    SELECT block, class, j, floor(sum(alpha * y * x[j]) * {one} + 0.5) / {one} AS part, any_value(scale) AS scale
                    FROM a{r + 1} JOIN pairs USING (doc_id, class), range(1, {_WIDTH + 1}) r(j) GROUP BY block, class, j)
                GROUP BY class, j)
            GROUP BY class)"""
        )
    values = " UNION ALL ".join(
        f"""SELECT CAST({r} AS INTEGER) AS round, class,
            {REG / 2}::DOUBLE * any_value(list_dot_product(w, w)) + avg(greatest(0.0, 1.0 - y * list_dot_product(w, x))) AS primal,
            avg(alpha) - {REG / 2}::DOUBLE * any_value(list_dot_product(w, w)) AS dual
        FROM pairs JOIN a{r} USING (doc_id, class) JOIN w{r} USING (class) GROUP BY class"""
        for r in range(ROUNDS + 1)
    )
    return "WITH RECURSIVE " + ",\n".join([*ctes, f"worth AS ({values})"])


_FEATURES = "[" + ", ".join(f"'{x}'" for x in [*LETTERS, ""]) + "]"
ORACLES = {
    "svm_dual_rounds": f"""{_rounds_sql()}
      SELECT round, class, round(primal, {DIGITS}) AS primal, round(dual, {DIGITS}) AS dual, round(primal - dual, {DIGITS}) AS gap FROM worth""",
    "svm_dual_weights": f"""{_rounds_sql()}
      SELECT class, ({_FEATURES})[j] AS feature, round(w[j], {DIGITS}) AS weight FROM w{ROUNDS}, range(1, {_WIDTH + 1}) r(j)""",
}
