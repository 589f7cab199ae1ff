import random

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from marginalia.operators import estimators as est
from marginalia.operators import proximal
from marginalia.operators.proximal import Setting

FEATURES = ["a", "b", "c", "d"]
POINTS = "label double, a double, b double, c double, d double"


def rows(n=300):
    rng = random.Random(11)
    out = []
    for _ in range(n):
        x = [rng.gauss(3, 1), rng.gauss(0, 5), rng.random(), 7.0]
        out.append((float(x[0] - 0.3 * x[1] + rng.gauss(0, 1) > 3), *x))
    return out


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(rows(), POINTS).repartition(3).cache()


def test_all_settings_come_out_as_each_alone_on_any_partitions(spark, points):
    settings = proximal.grid((0.01, 1.0), (True, False), (4,), (0.1, 1.0))
    whole = proximal.fit_all(points, FEATURES, settings)
    for parts in (1, 8):
        again = proximal.fit_all(points.repartition(parts), FEATURES, settings)
        assert np.abs(again.weights - whole.weights).max() < 1e-12
    for k in (0, 3, 6):
        alone = proximal.fit_all(points, FEATURES, [settings[k]])
        assert np.abs(alone.weights[0] - whole.weights[k]).max() < 1e-12
    assert (whole.weights[:, 3] == 0).all() and (whole.weights[2:4, -1] == 0).all()


def test_solution_holds_its_conditions_and_is_that_of_spark(spark, points):
    setting = Setting(0.02, True, 150, 1.0)
    fitted = proximal.fit_all(points, FEATURES, [setting], 1e-6)
    found = proximal.certificate(points, fitted).collect()
    own = {r.feature: r.coefficient for r in found}
    # The gradient again, in SQL, from the returned coefficients.
    con = duckdb.connect()
    con.execute(f"CREATE TABLE points({', '.join(f'{c} DOUBLE' for c in ['label', *FEATURES])})")
    con.executemany("INSERT INTO points VALUES (?, ?, ?, ?, ?)", rows())
    margin = " + ".join([*(f"{own[f]!r} * {f}" for f in FEATURES), repr(own[""])])
    error = f"(1 / (1 + exp(-({margin}))) - label)"
    for r in found[:3]:
        scale = con.execute(f"SELECT stddev_pop({r.feature}) FROM points").fetchone()[0]
        # The intercept's condition makes the mean error zero, so centring does not change the gradient.
        gradient = con.execute(f"SELECT avg({error} * {r.feature}) FROM points").fetchone()[0] / scale
        assert gradient == pytest.approx(r.gradient, abs=1e-4)
        if r.weight:
            assert gradient == pytest.approx(-setting.lasso * np.sign(r.weight), abs=1e-4)
        else:
            assert abs(gradient) <= setting.lasso + 1e-4
        assert r.violation < 1e-4 and r.penalty == setting.lasso
    model = est.logistic_regression(0.02, 1.0, 500).fit(points.withColumn("features", array_to_vector(F.array(*FEATURES))))
    assert [own[f] for f in FEATURES] == pytest.approx(list(model.coefficients), abs=2e-3)
    assert own[""] == pytest.approx(model.intercept, abs=5e-3)


def test_areas(spark):
    rng = random.Random(2)
    given = [(k % 3, float(rng.random() < 0.4), rng.randrange(30)) for k in range(400)] + [(9, 1.0, 4), (9, 1.0, 5)]
    got = {r.setting: r.area for r in proximal.areas(spark.createDataFrame(given, "setting int, label double, score bigint")).collect()}
    for s in range(3):
        ones, zeros = ([v for k, y, v in given if k == s and y == label] for label in (1.0, 0.0))
        wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
        assert got[s] == pytest.approx(wins / len(ones) / len(zeros), abs=1e-12)
    assert got[9] is None


def test_search_and_best(spark, points):
    split = points.withColumn("split", F.when(F.col("a") * 1000 % 5 < 4, "train").otherwise("validation"))
    settings = proximal.grid((0.01, 10.0), (True,), (5,), (1.0,))
    found, fitted = proximal.search(split, FEATURES, settings)
    areas = {r.setting: r.area for r in found.collect()}
    assert areas[0] > 0.8 and areas[1] == 0.5 and fitted.steps == [5, 5]
    assert {r.param: r.value for r in proximal.best(found).collect()}["reg_param"] == 0.01


def test_no_rows(spark):
    fitted = proximal.fit_all(spark.createDataFrame([], POINTS), FEATURES, [Setting()])
    assert not fitted.weights.any() and fitted.rows == 0
