import pytest
from pyspark.sql import functions as F

from marginalia.functions import vectors
from marginalia.operators import perceptron as p

from samples import PERCEPTRON

# margins of every visit, epoch by epoch, of the sequential perceptron
MARGINS = [0, 22, -7, 12, 14, -4, 5, 6, -1, -2, 20, -5, 10, 12, -2, 3, 4, 1]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(PERCEPTRON, "id bigint, features array<double>, label double")


def alphas(df, fit):
    return [r.alpha for r in p.perceptron_alpha(df, fit).orderBy("id").collect()]


@pytest.mark.parametrize("rate", [1.0, 0.5])
def test_sequential(rows, rate):
    fit = p.perceptron_fit(rows, "mixing", rate=rate, shards=1)
    assert (len(fit.epochs), fit.weights, fit.bias) == (6, (rate, rate), -3 * rate) and fit.converged
    assert alphas(rows, fit) == [2, 0, 5]


def test_every_visit(rows):
    fit = p.perceptron_fit(rows, "mixing", shards=1)
    log = p.visit_log(rows, fit).orderBy("epoch", "id").collect()
    assert [r.margin for r in log] == MARGINS
    assert [r.mistake for r in log] == [m <= 0 for m in MARGINS]


@pytest.mark.parametrize(
    "shards, epochs, weights, bias, alpha",
    [([0, 0, 1], 7, (0.5, 0.5), -1.5, [2, 0, 5]), ([0, 1, 2], 13, (1, 1 / 3), -7 / 3, [2, 2, 11])],
)
def test_mixing(spark, shards, epochs, weights, bias, alpha):
    data = [(*row, shard) for row, shard in zip(PERCEPTRON, shards)]
    df = spark.createDataFrame(data, "id bigint, features array<double>, label double, shard int")
    fit = p.perceptron_fit(df, "mixing", shards=max(shards) + 1)
    assert len(fit.epochs) == epochs and fit.converged
    assert fit.weights == pytest.approx(weights) and fit.bias == pytest.approx(bias)
    assert alphas(df, fit) == alpha


def test_batch(rows, spark):
    fit = p.perceptron_fit(rows)
    assert (len(fit.epochs), fit.weights, fit.bias, fit.converged) == (13, (3.0, 1.0), -7.0, True)
    log = p.epoch_log(spark, fit).orderBy("epoch").collect()
    assert [r.epoch for r in log] == list(range(1, 14)) and log[-1].mistakes == 0
    assert p.model_table(spark, fit).first().weights == [3.0, 1.0]


@pytest.mark.parametrize("mode, shards", [("batch", None), ("mixing", 1), ("mixing", 3)])
@pytest.mark.parametrize("rate", [1.0, 0.5])
def test_dual_equals_primal(spark, mode, shards, rate):
    df = spark.range(300).select(
        "id",
        F.array((F.col("id") % 13).cast("double"), (F.col("id") % 7).cast("double")).alias("features"),
        F.when((F.col("id") % 13) > (F.col("id") % 7) + 2, 1.0).otherwise(-1.0).alias("label"),
    )
    fit = p.perceptron_fit(df, mode, rate=rate, max_epochs=6, shards=shards)
    model = p.dual_model(p.perceptron_alpha(df, fit), fit).first()
    assert model.weights == pytest.approx(list(fit.weights)) and model.bias == pytest.approx(fit.bias)


def test_result_does_not_depend_on_input_partitioning(spark):
    df = spark.range(500).select(
        "id",
        F.array(F.sin("id"), F.cos("id")).alias("features"),
        F.when(F.sin("id") > 0.1, 1.0).otherwise(-1.0).alias("label"),
    )
    fits = [p.perceptron_fit(df.repartition(n), "mixing", max_epochs=4, shards=3) for n in (1, 5)]
    assert fits[0].weights == pytest.approx(fits[1].weights, abs=1e-12)
    assert [e.mistakes for e in fits[0].epochs] == [e.mistakes for e in fits[1].epochs]


@pytest.mark.parametrize("mode", ["batch", "mixing"])
def test_inseparable_rows_stop_at_the_cap(spark, mode):
    data = [(0, [1.0], 1.0), (1, [1.0], -1.0)]
    df = spark.createDataFrame(data, "id bigint, features array<double>, label double")
    fit = p.perceptron_fit(df, mode, max_epochs=5, shards=1)
    assert len(fit.epochs) == 5 and not fit.converged


@pytest.mark.parametrize("mode", ["batch", "mixing"])
def test_wide_rows(spark, mode, monkeypatch):
    monkeypatch.setattr(vectors, "UNROLLED_DOT", 1)
    monkeypatch.setattr(vectors, "UNROLLED_SUM", 1)
    df = spark.createDataFrame(PERCEPTRON, "id bigint, features array<double>, label double")
    fit = p.perceptron_fit(df, mode, shards=1)
    assert fit.weights == ((3.0, 1.0) if mode == "batch" else (1.0, 1.0))


@pytest.mark.parametrize(
    "bad, message",
    [
        ((1, [1.0], 1.0), "2 numbers"),
        ((1, [1.0, float("nan")], 1.0), "2 numbers"),
        ((1, [1.0, 2.0], 0.0), "must be -1 or 1"),
        ((0, [1.0, 2.0], 1.0), "ids must be unique"),
    ],
)
def test_bad_rows_fail(spark, bad, message):
    df = spark.createDataFrame([PERCEPTRON[0], bad], "id bigint, features array<double>, label double").coalesce(1)
    with pytest.raises(Exception, match=message):
        p.perceptron_fit(df, "mixing", shards=1)


def test_lookahead_equals_row_by_row():
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.integers(-4, 5, (700, 3)).astype(float)
    y = np.where(x[:, 0] + rng.integers(-1, 2, 700) > 0, 1.0, -1.0)
    w, b, mistakes = np.zeros(3), 0.0, 0
    for row, label in zip(x, y):
        if label * (w @ row + b) <= 0:
            w, b, mistakes = w + 0.5 * label * row, b + 0.5 * label, mistakes + 1
    got = p._visit_in_order(x, y, np.zeros(3), 0.0, 0.5)
    assert (got[0] == w).all() and got[1:] == (b, mistakes)
