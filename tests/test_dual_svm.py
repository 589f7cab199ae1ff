import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.operators import dual_svm

SCHEMA = "id bigint, features array<double>, label string"
NAMES = ["a", "b", "c"]


def rows(n=240):
    rng = random.Random(5)
    centre = {"a": (2.0, 0.0), "b": (-1.0, 2.0), "c": (0.0, -2.0)}
    out = []
    for i in range(n):
        label = rng.choice(NAMES)
        out.append((i, [rng.gauss(v, 1.2) for v in centre[label]], label if i % 40 else None))
    return out


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


def test_values_follow_from_weights_and_duals_and_close_in_on_each_other(spark, points):
    reg = 0.05
    fitted = dual_svm.fit(points, NAMES, reg, 5e-3, 60, block_rows=40)
    assert fitted.blocks == 6 and 0 <= fitted.gap <= 5e-3
    gone_up = np.diff([r.dual for r in fitted.rounds], axis=0)
    assert (gone_up >= -1e-6).all()
    con = duckdb.connect()
    con.execute("CREATE TABLE points(id BIGINT, x1 DOUBLE, x2 DOUBLE, label VARCHAR)")
    con.executemany("INSERT INTO points VALUES (?, ?, ?, ?)", [(i, *x, label) for i, x, label in rows()])
    con.execute("CREATE TABLE duals(id BIGINT, class VARCHAR, alpha DOUBLE)")
    con.executemany("INSERT INTO duals VALUES (?, ?, ?)", [tuple(r) for r in dual_svm.duals(fitted).collect()])
    for name, w, primal, dual in zip(NAMES, fitted.weights.tolist(), fitted.rounds[-1].primal, fitted.rounds[-1].dual):
        y = f"CASE WHEN label = '{name}' THEN 1 ELSE -1 END"
        again = con.execute(
            f"""SELECT sum(alpha * {y} * x1) / {reg * 240}, sum(alpha * {y} * x2) / {reg * 240}, sum(alpha * {y}) / {reg * 240},
                sum(alpha) / 240, min(alpha) > 0 AND max(alpha) <= 1 FROM points JOIN duals USING (id) WHERE class = '{name}'"""
        ).fetchone()
        assert again[:3] == pytest.approx(list(w), abs=1e-6) and again[4]
        loss = con.execute(f"SELECT avg(greatest(0, 1 - ({y}) * ({w[0]!r} * x1 + {w[1]!r} * x2 + {w[2]!r}))) FROM points").fetchone()[0]
        half = reg / 2 * float(np.dot(w, w))
        assert primal == pytest.approx(half + loss, abs=1e-6) and dual == pytest.approx(again[3] - half, abs=1e-6)


def test_optimum_is_the_same_for_any_blocks_and_no_nearby_weights_are_better(points):
    fits = [dual_svm.fit(points, NAMES, 0.05, 5e-3, 60, size) for size in (80, 1000)]
    assert np.abs(fits[0].rounds[-1].primal - fits[1].rounds[-1].primal).max() <= 5e-3
    x = np.array([[*f, 1.0] for _, f, _ in rows()])
    rng = np.random.default_rng(1)
    for k, name in enumerate(NAMES):
        y = np.array([1.0 if label == name else -1.0 for *_, label in rows()])
        value = lambda w: 0.025 * w @ w + np.maximum(0, 1 - y * (x @ w)).mean()
        own = fits[1].weights[k]
        assert all(value(own + d) > value(own) - fits[1].gap for d in rng.normal(0, 0.2, (200, 3)))


def test_partitions_do_not_matter(points):
    weights = [dual_svm.fit(points.repartition(p), NAMES, 0.05, 0.0, 3, 50).weights for p in (1, 4, 17)]
    assert (weights[0] == weights[1]).all() and (weights[0] == weights[2]).all()


def test_prediction_takes_the_largest_margin(points):
    fitted = dual_svm.fit(points, NAMES, 0.05, 1e-2)
    got = dict(points.select("id", dual_svm.prediction(F.col("features"), fitted)).collect())
    assert got == {i: NAMES[int(np.argmax(fitted.weights @ [*x, 1.0]))] for i, x, _ in rows()}
    assert np.mean([got[i] == label for i, _, label in rows() if label]) > 0.8


def test_bad_input(spark, points):
    with pytest.raises(Exception, match="ids must be unique"):
        dual_svm.fit(points.unionByName(points.filter("id = 7")), NAMES)
    with pytest.raises(ValueError, match="no rows"):
        dual_svm.fit(points.filter("id < 0"), NAMES)
    with pytest.raises(ValueError, match="reg"):
        dual_svm.fit(points, NAMES, 0.0)
    with pytest.raises(Exception, match="scale the features"):
        dual_svm.fit(spark.createDataFrame([(1, [1e12], "a"), (2, [1e12], "a")], SCHEMA), ["a", "b"], 1e30)
    one = dual_svm.fit(spark.createDataFrame([(1, [0.0], "a")], SCHEMA), ["a", "b"], 0.1, 1e-6)
    assert one.gap <= 1e-6
