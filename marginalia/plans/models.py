"""The other classifiers, tuning, inspection and the comparison table; splits and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators import estimators as est
from marginalia.operators import evaluate, tuning
from marginalia.operators.split import key_sample, key_split, one_vs_rest_label, random_split, side
from marginalia.operators.staging import staged_path
from marginalia.plans import language
from marginalia.sources.labelled import read_measurements, with_features, with_label
from marginalia.sources.tables import read_table, spread

FLAG_FEATURES = ["l_quantity", "l_discount", "l_tax"]
HIDDEN = 16


def flag_points(spark: SparkSession, folder: str) -> DataFrame:
    """``(label, features, split)`` of lineitem: the return flag, split by order."""
    lines = spread(read_table(spark, folder, "lineitem", "l_orderkey", "l_returnflag", *FLAG_FEATURES), "l_orderkey")
    split = key_split(with_label(lines, "l_returnflag"), "l_orderkey", hashed=False)
    return with_features(split, FLAG_FEATURES).select("label", "features", "split")


def measurements_csv(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem numbers and return flag written as headerless CSV, read back and summed by label."""
    path = staged_path(spark, "measurements")
    read_table(spark, folder, "lineitem", *FLAG_FEATURES, "l_returnflag").write.csv(path)
    rows = with_label(read_measurements(spark, path, FLAG_FEATURES, "flag"), "flag")
    sums = [F.round(F.sum(c), 4).alias(f"sum_{c}") for c in FLAG_FEATURES]
    return rows.groupBy("label").agg(F.count("*").alias("n"), *sums)


def _accuracy(estimator):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return evaluate.accuracy(language.scored(language.points(spark, folder), estimator()), "split")

    return query


def _network():
    return est.multilayer_perceptron([len(language.LETTERS), HIDDEN, 4], seed=1)


def _train(spark: SparkSession, folder: str) -> DataFrame:
    return side(language.points(spark, folder), "train")


def tree_rules(spark: SparkSession, folder: str) -> DataFrame:
    train = _train(spark, folder)
    return est.tree_description(est.fit(est.decision_tree(), train), train)


def logreg_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    train = _train(spark, folder)
    model = est.fit(est.logistic_regression(), train)
    return est.linear_coefficients(model, train, language.LETTERS)


def _english(spark: SparkSession, folder: str) -> DataFrame:
    """The training side with label 1 for English (index 1) and 0 for the rest."""
    return _train(spark, folder).withColumn("label", one_vs_rest_label(F.col("label"), 1.0))


def tune_logreg(spark: SparkSession, folder: str) -> DataFrame:
    train = _english(spark, folder)
    return tuning.search_results(tuning.search(train), train)


def tune_best(spark: SparkSession, folder: str) -> DataFrame:
    train = _english(spark, folder)
    return tuning.best_parameters(tuning.search(train), train)


def english_auc(spark: SparkSession, folder: str) -> DataFrame:
    """Area under the ROC curve of one number, the share of the letter h, for English or not."""
    rows = language.labelled_counts(spark, folder)
    letters = reduce(lambda a, b: a + b, [F.col(c) for c in language.COUNTS])
    share = F.coalesce(F.try_divide(F.col("n_h"), letters), F.lit(0.0))
    scored = rows.select(one_vs_rest_label(F.col("label"), 1.0).alias("label"), share.alias("rawPrediction"))
    area = evaluate.area_under_roc(scored)
    return spark.createDataFrame([(round(area, 6),)], "area double")


def comparison_table(spark: SparkSession, folder: str) -> DataFrame:
    methods = {
        "naive bayes": est.naive_bayes,
        "decision tree": est.decision_tree,
        "logistic regression": est.logistic_regression,
    }
    datasets = {"language": language.points(spark, folder), "returnflag": flag_points(spark, folder)}
    reports = []
    for dataset, table in datasets.items():
        with est.training_rows(side(table, "train")) as rows:
            models = {name: estimator().fit(rows) for name, estimator in methods.items()}
        reports.append(evaluate.report_all(est.score_all(models, table), list(models), dataset))
    return evaluate.comparison(reports, list(datasets))


def nb_flag_pi(spark: SparkSession, folder: str) -> DataFrame:
    points = flag_points(spark, folder)
    rows = est.naive_bayes_priors(est.fit(est.naive_bayes(), points), points)
    return rows.select("label", F.round("pi", 6).alias("pi"))


def nb_flag_theta(spark: SparkSession, folder: str) -> DataFrame:
    points = flag_points(spark, folder)
    rows = est.naive_bayes_likelihoods(est.fit(est.naive_bayes(), points), points, FLAG_FEATURES)
    return rows.select("label", "feature", F.round("theta", 6).alias("theta"))


def key_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders", "o_orderkey")
    return key_split(orders, "o_orderkey").groupBy("split").agg(F.count("*").alias("n"))


def random_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders", "o_orderkey")
    train, dev = random_split(orders, [0.75, 0.25], seed=1)
    parts = train.withColumn("split", F.lit("train")).unionByName(dev.withColumn("split", F.lit("dev")))
    return parts.groupBy("split").agg(F.count("*").alias("n"))


def sample_key(spark: SparkSession, folder: str) -> DataFrame:
    return key_sample(read_table(spark, folder, "customer", "c_custkey", "c_mktsegment"), "c_custkey", 1, 5)


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = [
        read_table(spark, folder, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name in ("documents", "embeddings", "lineitem", "orders")
    ]
    return reduce(DataFrame.unionByName, counts)


QUERIES = {
    "row_counts": row_counts,
    "key_split_counts": key_split_counts,
    "random_split_counts": random_split_counts,
    "sample_key": sample_key,
    "measurements_csv": measurements_csv,
    "nb_flag_pi": nb_flag_pi,
    "nb_flag_theta": nb_flag_theta,
    "tree_accuracy": _accuracy(est.decision_tree),
    "tree_rules": tree_rules,
    "logreg_accuracy": _accuracy(est.logistic_regression),
    "logreg_coefficients": logreg_coefficients,
    "svm_ovr_accuracy": _accuracy(est.one_vs_rest_svm),
    "mlp_accuracy": _accuracy(_network),
    "tune_logreg": tune_logreg,
    "tune_best": tune_best,
    "english_auc": english_auc,
    "comparison_table": comparison_table,
}


def _bucket_sql(key: str, buckets: int) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % {buckets}"


_FLAGS_SQL = """flags AS (
  SELECT l_returnflag, CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS DOUBLE) AS label
  FROM (SELECT DISTINCT l_returnflag FROM lineitem)
)"""

ORACLES = {
    "row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n FROM {name}"
        for name in ("documents", "embeddings", "lineitem", "orders")
    ),
    "key_split_counts": f"""SELECT CASE WHEN {_bucket_sql('o_orderkey', 4)} < 3 THEN 'train' ELSE 'test' END AS split,
      count(*) AS n FROM orders GROUP BY 1""",
    "sample_key": f"SELECT c_custkey, c_mktsegment FROM customer WHERE {_bucket_sql('c_custkey', 5)} < 1",
    "measurements_csv": f"""WITH {_FLAGS_SQL}
      SELECT label, count(*) AS n, {', '.join(f'round(sum({c}), 4) AS sum_{c}' for c in FLAG_FEATURES)}
      FROM lineitem JOIN flags USING (l_returnflag) GROUP BY label""",
    "nb_flag_pi": f"""WITH {_FLAGS_SQL},
      classes AS (SELECT label, count(*) AS n FROM lineitem JOIN flags USING (l_returnflag) GROUP BY label)
      SELECT label, round(ln(n + 1.0) - ln(sum(n) OVER () + 1.0 * count(*) OVER ()), 6) AS pi FROM classes""",
    "nb_flag_theta": f"""WITH {_FLAGS_SQL},
      cells AS (
        UNPIVOT (SELECT label, {', '.join(FLAG_FEATURES)} FROM lineitem JOIN flags USING (l_returnflag))
        ON {', '.join(FLAG_FEATURES)} INTO NAME feature VALUE x
      ),
      sums AS (SELECT label, feature, sum(x) AS s FROM cells GROUP BY label, feature)
      SELECT label, feature,
             round(ln(s + 1.0) - ln(sum(s) OVER (PARTITION BY label) + {len(FLAG_FEATURES)}.0), 6) AS theta
      FROM sums""",
    "english_auc": f"""WITH {language._POINTS_SQL},
      scores AS (
        SELECT CASE WHEN label = 1 THEN 1 ELSE 0 END AS label,
               CASE WHEN {' + '.join(language.COUNTS)} = 0 THEN 0.0 ELSE n_h / ({' + '.join(language.COUNTS)}) END AS score
        FROM points
      ),
      ranked AS (
        SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM scores
      )
      SELECT round((sum(place) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
        / (count(*) FILTER (WHERE label = 1) * CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE)), 6) AS area FROM ranked""",
}
