import numpy as np
import pytest

from marginalia.operators.neighbours import majority, nearest


def brute(train, test, k):
    found = []
    for tid, t in test:
        order = sorted((sum((a - b) ** 2 for a, b in zip(t, x)), xid, label) for xid, x, label in train)
        found += [(tid, rank, xid, label, float(np.sqrt(d))) for rank, (d, xid, label) in enumerate(order[:k], 1)]
    return sorted(found)


def tables(spark, train, test):
    train_df = spark.createDataFrame(train, "id bigint, features array<double>, label double")
    return train_df.repartition(3), spark.createDataFrame(test, "id bigint, features array<double>").repartition(2)


def found(spark, train, test, k, **options):
    return sorted(map(tuple, nearest(*tables(spark, train, test), k, **options).collect()))


def clusters(n, width, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 10, (6, width))
    x = centres[rng.integers(0, 6, n)] + rng.normal(0, spread, (n, width))
    return [[float(v) for v in row] for row in x]


def same(got, expected):
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert [g[4] for g in got] == pytest.approx([e[4] for e in expected], abs=1e-12)


@pytest.mark.parametrize("spread", [0.2, 20.0], ids=["clustered", "scattered"])
@pytest.mark.parametrize("block_rows", [7, 4096])
def test_equals_brute_force(spark, spread, block_rows):
    train = [(i, x, float(i % 3)) for i, x in enumerate(clusters(150, 3, 1, spread))]
    test = [(1000 + i, x) for i, x in enumerate(clusters(40, 3, 2, spread))]
    same(found(spark, train, test, 4, block_rows=block_rows), brute(train, test, 4))


@pytest.mark.parametrize("pivots", [1, 4, 50])
def test_copies_and_ties(spark, pivots):
    """A third of the training rows and half of the test rows are copies; grid values give equal distances."""
    rng = np.random.default_rng(3)
    points = [[float(v) for v in row] for row in rng.integers(0, 4, (80, 2))] + [[1.0, 1.0]] * 40
    train = [(i, x, float(i % 2)) for i, x in enumerate(points)]
    test = [(i, [1.0, 1.0]) for i in range(20)] + [(20 + i, [float(i % 5), float(i % 3)]) for i in range(20)]
    same(found(spark, train, test, 5, block_rows=9, pivots=pivots), brute(train, test, 5))


def test_large_offset(spark):
    """Far from the origin quick distances lose digits; the result must not."""
    rng = np.random.default_rng(4)
    points = [[1e7 + float(v) for v in row] for row in rng.normal(0, 1, (100, 2))]
    train = [(i, x, 0.0) for i, x in enumerate(points[:80])]
    test = [(i, x) for i, x in enumerate(points[80:])]
    same(found(spark, train, test, 3, block_rows=16), brute(train, test, 3))


def test_fewer_rows_than_k(spark):
    train = [(0, [0.0], 1.0), (1, [2.0], 0.0)]
    same(found(spark, train, [(9, [0.5])], 5), brute(train, [(9, [0.5])], 5))


def test_all_rows_equal(spark):
    train = [(i, [2.0, 2.0], 0.0) for i in range(50)]
    test = [(i, [2.0, 2.0]) for i in range(10)]
    same(found(spark, train, test, 3, block_rows=8), brute(train, test, 3))


def test_majority_prefers_the_smaller_label_on_ties(spark):
    rows = [(1, 1, 5, 2.0, 0.1), (1, 2, 6, 1.0, 0.2), (2, 1, 5, 2.0, 0.1), (2, 2, 7, 2.0, 0.3), (2, 3, 6, 1.0, 0.4)]
    df = spark.createDataFrame(rows, "test_id bigint, rank int, train_id bigint, label double, distance double")
    assert sorted(map(tuple, majority(df).collect())) == [(1, 1.0), (2, 2.0)]


def test_names_as_ids_and_labels(spark):
    rng = np.random.default_rng(6)
    train = [(f"row {i}", [float(v) for v in rng.integers(0, 5, 2)], "even" if i % 2 == 0 else "odd") for i in range(60)]
    test = [(f"test {i}", [float(v) for v in rng.integers(0, 5, 2)]) for i in range(15)]
    train_df = spark.createDataFrame(train, "id string, features array<double>, label string")
    test_df = spark.createDataFrame(test, "id string, features array<double>")
    got = sorted(map(tuple, nearest(train_df, test_df, 3, block_rows=10).collect()))
    same(got, brute(train, test, 3))


def test_no_training_rows(spark):
    train, test = tables(spark, [(0, [1.0], 0.0)], [(1, [1.0])])
    with pytest.raises(ValueError, match="no training rows"):
        nearest(train.filter("id > 5"), test, 1)


def test_bad_vectors_fail(spark):
    train, test = tables(spark, [(0, [1.0, 2.0], 0.0)], [(1, [1.0])])
    with pytest.raises(Exception, match="2 numbers"):
        nearest(train, test, 1).collect()


def test_slices_do_not_follow_the_order_of_rows(spark):
    """Clusters that repeat with the row order still give blocks near ``block_rows``."""
    from marginalia.operators import neighbours
    from pyspark.sql import functions as F

    rows = [(i, [float(100 * (i % 10)), float(i) / 1e4], 0) for i in range(5000)]
    train = spark.createDataFrame(rows, "id bigint, features array<double>, label int")
    sliced = train.withColumn("slice", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)))
    assert sliced.groupBy((F.col("id") % 10).alias("cell"), "slice").count().agg(F.max("count")).first()[0] < 40
    near = neighbours.nearest(train, train.filter("id < 20"), 2, block_rows=100)
    assert {(r.test_id, r.train_id) for r in near.filter("rank = 1").collect()} == {(i, i) for i in range(20)}
