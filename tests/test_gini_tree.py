import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from marginalia.operators import estimators as est
from marginalia.operators import gini_tree
from marginalia.operators.scan import running_totals

FEATURES = ["x", "y", "z"]
POINTS = "label double, x double, y double, z double"


def rows(n, seed=5, classes=3):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x, y, z = rng.randrange(12), rng.randrange(40) / 4, rng.choice([-1.0, 0.0, 2.5])
        label = (x > 5) + (y > 4 and z > 0) if rng.random() < 0.85 else rng.randrange(classes)
        out.append((float(label), float(x), y, z))
    return out


def squares(labels):
    return sum(labels.count(c) ** 2 for c in set(labels)) / len(labels)


def grow(points, depth, number=1):
    """{node: (feature, threshold) or None} by trying every split."""
    labels = [p[0] for p in points]
    found = []
    for k in range(len(FEATURES)):
        for value in {p[k + 1] for p in points}:
            low = [p[0] for p in points if p[k + 1] <= value]
            high = [p[0] for p in points if p[k + 1] > value]
            if high:
                found.append((-round(squares(low) + squares(high), 9), k, value))
    if not depth or not found or len(set(labels)) == 1:
        return {number: None}
    score, k, value = min(found)
    if (-score - squares(labels)) / len(labels) <= 1e-9:
        return {number: None}
    low, high = [p for p in points if p[k + 1] <= value], [p for p in points if p[k + 1] > value]
    return {number: (FEATURES[k], value)} | grow(low, depth - 1, 2 * number) | grow(high, depth - 1, 2 * number + 1)


@pytest.mark.parametrize("n, depth, parts", [(200, 3, 1), (200, 4, 7), (12, 5, 3), (1, 2, 1)])
def test_every_split_is_the_best(spark, n, depth, parts):
    given = rows(n)
    nodes = gini_tree.fit(spark.createDataFrame(given, POINTS).repartition(parts), FEATURES, 3, depth)
    assert {k: (v.feature, v.threshold) if v.feature else None for k, v in nodes.items()} == grow(given, depth)


def test_nodes_count_the_rows_that_reach_them(spark):
    points = spark.createDataFrame(rows(300), POINTS)
    nodes = gini_tree.fit(points, FEATURES, 3, 4)
    table = {r.node: r for r in gini_tree.node_table(nodes, points).collect()}
    scored = gini_tree.score(nodes, points)
    for leaf, n in scored.groupBy("leaf").count().collect():
        while leaf:
            assert table[leaf].parent == (leaf // 2 or None)
            leaf //= 2
        assert n
    counted = {r["leaf"]: r["count"] for r in scored.groupBy("leaf").count().collect()}
    assert counted == {k: r.n for k, r in table.items() if r.feature is None}
    for r in table.values():
        assert r.n == sum(r.counts) and r.prediction == float(r.counts.index(max(r.counts)))
        if r.feature:
            assert table[2 * r.node].n + table[2 * r.node + 1].n == r.n and r.gain > 0


def test_expression_equals_the_fitted_model(spark):
    points = spark.createDataFrame(rows(400), POINTS)
    vectors = points.withColumn("features", array_to_vector(F.array(*FEATURES)))
    model = est.fit(est.decision_tree(4), vectors)
    nodes = gini_tree.from_model(model, FEATURES)
    both = gini_tree.score(nodes, est.score(model, vectors).withColumnRenamed("prediction", "given"))
    assert both.filter("prediction <> given").count() == 0 and len(nodes) == model.numNodes
    assert nodes[1].counts == tuple(r["count"] for r in points.groupBy("label").count().orderBy("label").collect())


def test_hard_cases(spark):
    empty = gini_tree.fit(spark.createDataFrame([], POINTS), FEATURES, 2)
    assert empty == {1: gini_tree.Node(1, (0, 0))}
    same = spark.createDataFrame([(0.0, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, 1.0), (None, 9.0, 9.0, 9.0)], POINTS)
    assert gini_tree.fit(same, FEATURES, 2) == {1: gini_tree.Node(1, (1, 1))}
    for bad in (None, float("nan")):
        with pytest.raises(Exception, match="y is not a number"):
            gini_tree.fit(spark.createDataFrame([(0.0, 1.0, bad, 1.0)], POINTS), FEATURES, 2)


@pytest.mark.parametrize("ranges", ["1", "6", "40"])
def test_running_totals_carry_over_ranges(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        given = [("hot" if k % 3 else f"g{k % 5}", k % 97, k) for k in range(600)]
        df = spark.createDataFrame(given, "g string, o int, n int")
        for r in running_totals(df, ["g"], "o", ["n"]).collect():
            own = [(o, n) for g, o, n in given if g == r.g]
            assert r.upto_n == sum(n for o, n in own if o <= r.o) and r.all_n == sum(n for _, n in own)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
