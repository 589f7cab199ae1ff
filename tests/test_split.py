from pyspark.sql import functions as F

from marginalia.operators import split


def test_key_split_is_complete_and_independent_of_partitioning(spark):
    df = spark.range(1000)
    sides = [
        {r.id: r.split for r in split.key_split(df.repartition(n), "id").collect()} for n in (1, 3, 7)
    ]
    assert sides[0] == sides[1] == sides[2] and len(sides[0]) == 1000
    train = sum(1 for s in sides[0].values() if s == "train")
    assert 680 < train < 820


def test_sides_partition_the_table(spark):
    df = split.key_split(spark.range(100), "id", hashed=False)
    train, test = split.side(df, "train"), split.side(df, "test")
    assert train.columns == ["id"] and train.count() == 75 and test.count() == 25
    assert train.intersect(test).count() == 0


def test_negative_keys_stay_in_range(spark):
    keys = spark.range(-50, 50)
    buckets = keys.select(split.key_bucket(F.col("id"), 4, hashed=False).alias("b"))
    assert {r.b for r in buckets.distinct().collect()} == {0, 1, 2, 3}


def test_random_split_is_disjoint_and_complete(spark):
    df = spark.range(1000)
    train, dev = split.random_split(df, [0.75, 0.25], seed=3)
    assert train.count() + dev.count() == 1000 and train.intersect(dev).count() == 0


def test_samples(spark):
    df = spark.range(1000)
    sample = split.key_sample(df, "id", 1, 5)
    assert 140 < sample.count() < 260
    assert sample.subtract(split.key_sample(df, "id", 2, 5)).count() == 0
    assert 0 < split.random_sample(df, 0.1, seed=1).count() < 250


def test_class_reduction(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.0,)], "label double")
    ones = df.select(split.one_vs_rest_label(F.col("label"), 2.0).alias("l"))
    assert sorted(r.l for r in ones.collect()) == [0.0, 0.0, 1.0, 1.0]
    pair = split.two_classes(df, 0.0, 2.0)
    assert sorted(r.label for r in pair.collect()) == [0.0, 1.0, 1.0]
    assert [r[0] for r in spark.range(2).select(split.signed(F.col("id"))).collect()] == [-1.0, 1.0]
