"""Language of a document from how often each of twelve letters occurs in its text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.text import letter_counts
from marginalia.operators import estimators as est
from marginalia.operators import evaluate
from marginalia.operators.split import key_split, side
from marginalia.operators.staging import staged
from marginalia.sources.labelled import label_index, label_names, with_features, with_label
from marginalia.sources.tables import read_table, spread

LETTERS = list("aeiounrstdhl")
COUNTS = [f"n_{letter}" for letter in LETTERS]


def labelled_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, label, n_a, ...)``, label by alphabetical order of the language names."""
    documents = read_table(spark, folder, "documents", "doc_id", "text", "lang")
    names = label_names(documents, "lang")
    counted = spread(documents, "doc_id").select("doc_id", "lang", *letter_counts(F.col("text"), LETTERS))
    return with_label(counted, "lang", names).select("doc_id", "label", *COUNTS)


def points(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, label, features, split)``; three of four keys train.

    The counts are staged: they are a small fraction of the text, and training and scoring then
    read them instead of the text.
    """
    split = key_split(staged(labelled_counts(spark, folder)), "doc_id", hashed=False)
    return with_features(split, COUNTS).select("doc_id", "label", "features", "split")


def scored(table: DataFrame, estimator) -> DataFrame:
    """Every point with its prediction by a model trained on the training side."""
    model = est.fit(estimator, side(table, "train"))
    return est.scored_columns(est.score(model, table), "doc_id", "split")


def bayes_scored(spark: SparkSession, folder: str) -> DataFrame:
    return scored(points(spark, folder), est.naive_bayes())


def nb_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.accuracy(bayes_scored(spark, folder), "split")


def nb_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion(bayes_scored(spark, folder), "split")


def nb_correct(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.correct(bayes_scored(spark, folder)).select("doc_id", "label")


def nb_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = evaluate.report(bayes_scored(spark, folder), "naive bayes", "language")
    return evaluate.report_lines(rows)


def _bayes_model(spark: SparkSession, folder: str):
    table = points(spark, folder)
    return est.fit(est.naive_bayes(), side(table, "train")), table


def nb_pi(spark: SparkSession, folder: str) -> DataFrame:
    model, table = _bayes_model(spark, folder)
    return est.naive_bayes_priors(model, table).selectExpr("label", "round(pi, 6) AS pi")


def nb_theta(spark: SparkSession, folder: str) -> DataFrame:
    model, table = _bayes_model(spark, folder)
    rows = est.naive_bayes_likelihoods(model, table, LETTERS)
    return rows.selectExpr("label", "feature", "round(theta, 6) AS theta")


def lang_labels(spark: SparkSession, folder: str) -> DataFrame:
    return label_index(read_table(spark, folder, "documents", "lang"), "lang")


QUERIES = {
    "label_index": lang_labels,
    "labelled_points": labelled_counts,
    "nb_pi": nb_pi,
    "nb_theta": nb_theta,
    "nb_accuracy": nb_accuracy,
    "nb_confusion": nb_confusion,
    "nb_correct": nb_correct,
    "nb_report": nb_report,
}

_COUNTS_SQL = ", ".join(
    f"CAST(length(text) - length(replace(text, '{letter}', '')) AS DOUBLE) AS n_{letter}" for letter in LETTERS
)
_NAMES_SQL = "names AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS DOUBLE) AS label FROM (SELECT DISTINCT lang FROM documents))"
_POINTS_SQL = f"""{_NAMES_SQL},
points AS (
  SELECT doc_id, label, CASE WHEN doc_id % 4 < 3 THEN 'train' ELSE 'test' END AS split, {_COUNTS_SQL}
  FROM documents JOIN names USING (lang)
),
cells AS (
  UNPIVOT points ON {", ".join(COUNTS)} INTO NAME feature VALUE x
)"""
_BAYES_SQL = f"""{_POINTS_SQL},
classes AS (SELECT label, count(*) AS n FROM points WHERE split = 'train' GROUP BY label),
pis AS (
  SELECT label, ln(n + 1.0) - ln((SELECT sum(n) FROM classes) + 1.0 * (SELECT count(*) FROM classes)) AS pi
  FROM classes
),
sums AS (SELECT label, feature, sum(x) AS s FROM cells WHERE split = 'train' GROUP BY label, feature),
thetas AS (
  SELECT label, feature,
         ln(s + 1.0) - ln(sum(s) OVER (PARTITION BY label) + {len(LETTERS)}.0) AS theta
  FROM sums
)"""
_SCORED_SQL = f"""{_BAYES_SQL},
candidates AS (
  SELECT doc_id, split, c.label, t.label AS prediction, sum(c.x * t.theta) + max(p.pi) AS score
  FROM cells c JOIN thetas t USING (feature) JOIN pis p ON p.label = t.label
  GROUP BY doc_id, split, c.label, t.label
),
scored AS (
  SELECT doc_id, split, label, prediction FROM candidates
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, prediction) = 1
),
accuracies AS (
  SELECT split, count(*) AS n,
         CAST(sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS BIGINT) AS correct
  FROM scored GROUP BY split
)"""

ORACLES = {
    "label_index": f"WITH {_NAMES_SQL} SELECT lang AS name, label, count(*) AS n FROM documents JOIN names USING (lang) GROUP BY lang, label",
    "labelled_points": f"WITH {_POINTS_SQL} SELECT doc_id, label, {', '.join(COUNTS)} FROM points",
    "nb_pi": f"WITH {_BAYES_SQL} SELECT label, round(pi, 6) AS pi FROM pis",
    "nb_theta": f"WITH {_BAYES_SQL} SELECT label, substr(feature, 3) AS feature, round(theta, 6) AS theta FROM thetas",
    "nb_accuracy": f"WITH {_SCORED_SQL} SELECT split, n, correct, CAST(correct AS DOUBLE) / n AS accuracy FROM accuracies",
    "nb_confusion": f"WITH {_SCORED_SQL} SELECT split, label, prediction, count(*) AS n FROM scored GROUP BY split, label, prediction",
    "nb_correct": f"WITH {_SCORED_SQL} SELECT doc_id, label FROM scored WHERE label = prediction",
    "nb_report": f"""WITH {_SCORED_SQL} SELECT 'naive bayes' AS model, 'language' AS dataset,
        printf('accuracy test: %.4f, train: %.4f', max(CASE WHEN split = 'test' THEN CAST(correct AS DOUBLE) / n END), max(CASE WHEN split = 'train' THEN CAST(correct AS DOUBLE) / n END)) AS line
      FROM accuracies""",
}
