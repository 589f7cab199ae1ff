import pytest
from pyspark.sql import functions as F

from marginalia.functions import vectors
from marginalia.operators import linear

from samples import PERCEPTRON


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(PERCEPTRON, "id bigint, features array<double>, label double")


@pytest.fixture(params=[True, False], ids=["unrolled", "folded"])
def form(request, monkeypatch):
    if not request.param:
        monkeypatch.setattr(vectors, "UNROLLED_DOT", 0)
        monkeypatch.setattr(vectors, "UNROLLED_SUM", 0)


def test_linear_score(rows, form):
    scored = linear.linear_score(rows, [1.0, 1.0], -3.0).orderBy("id").collect()
    assert [r.score for r in scored] == [3.0, 4.0, -1.0]
    assert [r.prediction for r in scored] == [1.0, 1.0, -1.0]


def test_zero_score_is_negative(rows):
    assert {r.prediction for r in linear.linear_score(rows, [0.0, 0.0], 0.0).collect()} == {-1.0}


@pytest.mark.parametrize("bad", [[1.0], [1.0, 2.0, 3.0], [1.0, None], [1.0, float("nan")], None])
def test_bad_vectors_fail(spark, bad):
    df = spark.createDataFrame([(bad,)], "features array<double>")
    with pytest.raises(Exception, match="2 numbers without NULL or NaN"):
        linear.linear_score(df, [1.0, 1.0], 0.0).collect()


def test_dot_of_unequal_lengths_fails(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception, match="unequal length"):
        df.select(vectors.dot(F.col("a"), F.col("b"))).collect()


def test_weighted_sums(rows, form):
    total = linear.weighted_vector_sum(rows, F.col("label") * F.when(F.col("id") == 2, 5.0).otherwise(1.0))
    assert sorted(map(tuple, total.collect())) == [(0, 2.0), (1, 1.0)]
    assert vectors.weighted_sum(rows, F.col("features"), F.col("label"), 2) == ([6.0, 5.0], 1.0, 3)
    assert vectors.weighted_sum(rows.filter("id > 9"), F.col("features"), F.col("label"), 2) == ([0.0, 0.0], 0.0, 0)


def test_gram(rows, form):
    gram = linear.gram_columns(rows, [x for _, x, _ in PERCEPTRON]).orderBy("id")
    matrix = [r.gram for r in gram.collect()]
    assert matrix == [[18.0, 21.0, 6.0], [21.0, 25.0, 7.0], [6.0, 7.0, 2.0]]
    assert [r.squared_norm for r in linear.squared_norm(rows).orderBy("id").collect()] == [18.0, 25.0, 2.0]
    coefficients = [2.0, 0.0, -5.0]
    by_id = F.element_at(F.array(*map(F.lit, coefficients)), (F.col("id") + 1).cast("int"))
    products = [r.product for r in linear.gram_product(rows, by_id).orderBy("id").collect()]
    assert products == [sum(g * c for g, c in zip(row, coefficients)) for row in matrix]
