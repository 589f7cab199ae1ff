"""Trees on the return flag of lineitem: exact splits, nodes as a table, scores by expression."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators import estimators as est
from marginalia.operators import evaluate, gini_tree
from marginalia.operators.split import key_split, side
from marginalia.operators.staging import staged
from marginalia.plans.models import _FLAGS_SQL, FLAG_FEATURES, flag_points
from marginalia.sources.labelled import label_names, with_label
from marginalia.sources.tables import read_table, spread

DEPTH, DIGITS, MIN_GAIN = 3, 9, 1e-9


def _points(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """``(label, split, feature columns)`` of lineitem, and the number of classes."""
    lines = spread(read_table(spark, folder, "lineitem", "l_orderkey", "l_returnflag", *FLAG_FEATURES), "l_orderkey")
    names = label_names(lines, "l_returnflag")
    split = key_split(with_label(lines, "l_returnflag", names), "l_orderkey", hashed=False)
    return staged(split.select("label", "split", *(F.col(f).cast("double").alias(f) for f in FLAG_FEATURES))), len(names)


def _fit(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[int, gini_tree.Node]]:
    points, classes = _points(spark, folder)
    return points, gini_tree.fit(side(points, "train"), FLAG_FEATURES, classes, DEPTH, MIN_GAIN)


def gini_tree_nodes(spark: SparkSession, folder: str) -> DataFrame:
    points, nodes = _fit(spark, folder)
    table = gini_tree.node_table(nodes, points)
    return table.select(
        "node", "parent", "feature", "threshold", F.round("gain", DIGITS).alias("gain"), "n",
        F.array_join("counts", ",").alias("counts"), "prediction",
    )


def gini_tree_leaves(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, and rows with the right class, of every leaf and side of the split."""
    points, nodes = _fit(spark, folder)
    scored = gini_tree.score(nodes, points)
    right = F.count(F.when(F.col("label") == F.col("prediction"), 1))
    return scored.groupBy("split", "leaf").agg(F.count(F.lit(1)).alias("n"), right.alias("n_right"))


def tree_relation(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of Spark ML's own tree, each counted by its expression on the rows, with what the model says."""
    points = staged(flag_points(spark, folder))
    model = est.fit(est.decision_tree(DEPTH), side(points, "train"))
    columns = {f: F.get(vector_to_array("features"), F.lit(k)) for k, f in enumerate(FLAG_FEATURES)}
    by_model = est.score(model, points).withColumnRenamed("prediction", "by_model").withColumns(columns)
    scored = gini_tree.score(gini_tree.from_model(model, FLAG_FEATURES), by_model)
    same = F.count(F.when(F.col("prediction") == F.col("by_model"), 1))
    return scored.groupBy("split", "leaf").agg(F.count(F.lit(1)).alias("n"), same.alias("n_same"))


def gini_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    points, nodes = _fit(spark, folder)
    return evaluate.accuracy(gini_tree.score(nodes, points), "split")


QUERIES = {
    "gini_tree_nodes": gini_tree_nodes,
    "gini_tree_leaves": gini_tree_leaves,
    "gini_tree_accuracy": gini_accuracy,
    "tree_relation": tree_relation,
}


def _tree_sql() -> str:
    """Levels of the tree as common tables: ``rK`` holds rows in the nodes of depth K, ``sK`` the splits of those nodes."""
    casts = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FLAG_FEATURES)
    ctes = [
        f"""{_FLAGS_SQL},
        every AS (
            SELECT label, CASE WHEN l_orderkey % 4 < 3 THEN 'train' ELSE 'test' END AS split, {casts}
            FROM lineitem JOIN flags USING (l_returnflag)),
        r0 AS (SELECT 1::BIGINT AS node, * FROM every)"""
    ]
    cells = " UNION ALL ".join(f"SELECT node, label, {k} AS feature, {f} AS value FROM r{{d}} WHERE split = 'train'" for k, f in enumerate(FLAG_FEATURES))
    value = "CASE s.feature " + " ".join(f"WHEN {k} THEN r.{f}" for k, f in enumerate(FLAG_FEATURES)) + " END"
    for d in range(DEPTH):
        ctes.append(
            f"""counted{d} AS (SELECT node, feature, value, label, count(*) AS n FROM ({cells.format(d=d)}) GROUP BY ALL),
        spots{d} AS (SELECT DISTINCT node, feature, value FROM counted{d}),
        grid{d} AS (
            SELECT node, feature, value, label, coalesce(n, 0) AS n
            FROM spots{d} CROSS JOIN (SELECT label FROM flags) LEFT JOIN counted{d} USING (node, feature, value, label)),
        run{d} AS (
            SELECT node, feature, value, label, sum(n) OVER (PARTITION BY node, feature, label ORDER BY value) AS low,
                   sum(n) OVER (PARTITION BY node, feature, label) AS every
            FROM grid{d}),
        sides{d} AS (
            SELECT node, feature, value, sum(low)::DOUBLE AS n_low, sum(low * low)::DOUBLE AS low, sum(every - low)::DOUBLE AS n_high,
                   sum((every - low) * (every - low))::DOUBLE AS high, sum(every)::DOUBLE AS n, sum(every * every)::DOUBLE AS squares
            FROM run{d} GROUP BY ALL),
        s{d} AS (
            SELECT node, feature, value AS threshold, (low / n_low + high / n_high - squares / n) / n AS gain FROM sides{d} WHERE n_high > 0
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY low / n_low + high / n_high DESC, feature, value) = 1),
        r{d + 1} AS (
            SELECT 2 * r.node + CASE WHEN {value} <= s.threshold THEN 0 ELSE 1 END AS node, r.* EXCLUDE (node)
            FROM r{d} r JOIN s{d} s ON r.node = s.node AND s.gain > {MIN_GAIN})"""
        )
    levels = range(DEPTH + 1)
    nodes = " UNION ALL ".join(f"SELECT node, label FROM r{d} WHERE split = 'train'" for d in levels)
    splits = " UNION ALL ".join(f"SELECT * FROM s{d} WHERE gain > {MIN_GAIN}" for d in range(DEPTH))
    ctes.append(
        f"""splits AS ({splits}),
        held AS (
            SELECT node, label, count(k.label) AS n FROM (SELECT DISTINCT node FROM ({nodes})) CROSS JOIN (SELECT label FROM flags)
            LEFT JOIN ({nodes}) k USING (node, label) GROUP BY node, label),
        classes AS (
            SELECT node, sum(n)::BIGINT AS n, string_agg(n, ',' ORDER BY label) AS counts, arg_max(label, n * 1000 - label) AS prediction
            FROM held GROUP BY node),
        fallen AS ({' UNION ALL '.join(f'SELECT node, label, split FROM r{d} WHERE node NOT IN (SELECT node FROM splits)' for d in levels)})"""
    )
    return "WITH " + ",\n".join(ctes)


_NAMES = "CASE s.feature " + " ".join(f"WHEN {k} THEN '{f}'" for k, f in enumerate(FLAG_FEATURES)) + " END"
ORACLES = {
    "gini_tree_nodes": f"""{_tree_sql()}
      SELECT c.node, CASE WHEN c.node > 1 THEN c.node // 2 END AS parent, {_NAMES} AS feature, threshold,
             round(gain, {DIGITS}) AS gain, n, counts, prediction
      FROM classes c LEFT JOIN splits s ON s.node = c.node""",
    "gini_tree_leaves": f"""{_tree_sql()}
      SELECT split, f.node AS leaf, count(*) AS n, count(*) FILTER (WHERE label = prediction) AS n_right
      FROM fallen f JOIN classes c ON c.node = f.node GROUP BY ALL""",
    "gini_tree_accuracy": f"""{_tree_sql()}
      SELECT split, count(*) AS n, count(*) FILTER (WHERE label = prediction) AS correct,
             count(*) FILTER (WHERE label = prediction)::DOUBLE / count(*) AS accuracy
      FROM fallen f JOIN classes c ON c.node = f.node GROUP BY split""",
}
