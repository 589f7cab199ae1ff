import random

import numpy as np
import pytest

from marginalia.operators import network

SCHEMA = "features array<double>, label string"
NAMES = ["in", "on", "out"]


def rows(n=300):
    rng = random.Random(9)
    out = []
    for _ in range(n):
        x = [rng.uniform(-2, 2), rng.uniform(-2, 2)]
        size = np.hypot(*x)
        out.append((x, NAMES[0] if size < 0.9 else NAMES[1] if size < 1.6 else NAMES[2]))
    return out


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


def mean_loss(layers):
    x, label = np.array([r[0] for r in rows()]), [NAMES.index(r[1]) for r in rows()]
    for k, m in enumerate(layers):
        x = x @ m[:-1] + m[-1]
        x = 1 / (1 + np.exp(-x)) if k < len(layers) - 1 else np.exp(x) / np.exp(x).sum(axis=1, keepdims=True)
    return -np.log(x[range(len(x)), label]).mean()


def test_gradient_is_that_of_small_changes(points):
    layers = network.start_layers([2, 4, 3, 3], seed=2)
    found, loss = network.gradient(network.labelled_rows(points, NAMES, 2), layers, 300)
    assert loss == pytest.approx(mean_loss(layers), abs=1e-8)
    for k, m in enumerate(layers):
        assert found[k].shape == m.shape
        for i, j in np.ndindex(m.shape):
            around = []
            for step in (1e-5, -1e-5):
                moved = [own.copy() for own in layers]
                moved[k][i, j] += step
                around.append(mean_loss(moved))
            assert found[k][i, j] == pytest.approx((around[0] - around[1]) / 2e-5, abs=1e-6)


def test_loss_falls_and_partitions_do_not_matter(points):
    fits = [network.fit(points.repartition(p), NAMES, (8,), 12, rate=4.0) for p in (1, 5)]
    losses = [e.loss for e in fits[0].epochs]
    assert all(b < a for a, b in zip(losses, losses[1:])) and len(losses) == 13
    assert all((a == b).all() for a, b in zip(*(f.layers for f in fits)))
    # A far too large rate is halved until it helps.
    wild = network.fit(points, NAMES, (8,), 2, rate=4000.0)
    assert wild.epochs[1].rate < 4000 and wild.epochs[2].loss < wild.epochs[1].loss < wild.epochs[0].loss


def test_learns_what_no_line_can_tell(points):
    trained = network.fit(points, NAMES, (16,), 60, rate=2.0)
    got = network.predicted(points, trained)
    assert got.filter("label = prediction").count() > 0.62 * 300  # the largest class is half of the rows
    assert set(r.prediction for r in got.select("prediction").distinct().collect()) <= set(NAMES)


def test_bad_input(spark, points):
    with pytest.raises(ValueError, match="no rows"):
        network.fit(points.filter("label = '?'"), NAMES)
    with pytest.raises(Exception, match="unknown class"):
        network.fit(points, NAMES[:2], (2,), 1)
    with pytest.raises(Exception, match="unknown class"):
        network.fit(spark.createDataFrame([([1.0], None)], SCHEMA), NAMES, (2,), 1)
