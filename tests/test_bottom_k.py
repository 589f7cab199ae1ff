from collections import defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from marginalia.operators.bottom_k import exact_sample, exact_sample_by

ROWS = [(k, None if k % 5 == 4 else "ab"[k % 3 == 0], k % 2) for k in range(200)] + [(None, "a", 0), (None, "c", 1)]
SCHEMA = "id bigint, kind string, place int"


def order(row, seed=0):
    key = "" if row[0] is None else str(row[0])
    return md5(f"{seed}:{key}".encode()).hexdigest(), key


@pytest.mark.parametrize("rows", [0, 1, 7, 500])
@pytest.mark.parametrize("parts", [1, 6])
def test_smallest_hashes(spark, rows, parts):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(parts)
    got = {r.id for r in exact_sample(df, "id", rows, 3).collect()}
    assert got == {r[0] for r in sorted(ROWS, key=lambda r: order(r, 3))[:rows]}
    kinds = defaultdict(list)
    for r in sorted(ROWS, key=order):
        kinds[r[1]].append(r)
    found = exact_sample_by(df, "id", rows, "kind")
    assert found.columns == df.columns
    assert {tuple(r) for r in found.collect()} == {r for own in kinds.values() for r in own[:rows]}


def test_no_table_is_sorted_whole(spark):
    df = spark.range(1000).withColumn("kind", F.col("id") % 3)
    one = exact_sample(df, "id", 10)._jdf.queryExecution().executedPlan().toString()
    by = exact_sample_by(df, "id", 10, "kind")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in one and "rangepartitioning" not in one
    assert "WindowGroupLimit" in by and "Partial" in by


def test_samples_merge(spark):
    df = spark.createDataFrame(ROWS[:200], SCHEMA)
    halves = [exact_sample(df.filter(f"id % 2 = {k}"), "id", 9) for k in (0, 1)]
    merged = exact_sample(halves[0].unionByName(halves[1]), "id", 9).collect()
    assert sorted(merged) == sorted(exact_sample(df, "id", 9).collect())
