import pytest

from marginalia.operators import evaluate


@pytest.fixture
def scored(spark):
    rows = [
        ("train", 0.0, 0.0), ("train", 1.0, 1.0), ("train", 1.0, 0.0), ("train", None, 0.0),
        ("test", 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, "split string, label double, prediction double")


def test_accuracy_counts_missing_labels(scored):
    rows = {r.split: (r.n, r.correct, r.accuracy) for r in evaluate.accuracy(scored, "split").collect()}
    assert rows == {"train": (4, 2, 0.5), "test": (1, 1, 1.0)}
    assert evaluate.correct(scored).count() == 3


def test_accuracy_of_nothing_is_null(scored):
    row = evaluate.accuracy(scored.filter("split = 'none'")).first()
    assert (row.n, row.correct, row.accuracy) == (0, 0, None)


def test_confusion(scored):
    cells = {tuple(r) for r in evaluate.confusion(scored, "split").collect()}
    assert cells == {
        ("train", 0.0, 0.0, 1), ("train", 1.0, 1.0, 1), ("train", 1.0, 0.0, 1), ("train", None, 0.0, 1),
        ("test", 1.0, 1.0, 1),
    }


def test_reports(scored):
    rows = [evaluate.report(scored, m, d) for m in ("a", "b") for d in ("x", "y")]
    lines = evaluate.report_lines(rows[0]).first()
    assert lines.line == "accuracy test: 1.0000, train: 0.5000"
    table = evaluate.comparison(rows, ["x", "y"])
    assert table.columns == ["model", "split", "x", "y"]
    assert {tuple(r) for r in table.collect()} == {
        (m, s, v, v) for m in ("a", "b") for s, v in (("train", 0.5), ("test", 1.0))
    }


def test_area_under_roc(spark):
    rows = [(1.0, 0.9), (1.0, 0.5), (0.0, 0.5), (0.0, 0.1)]
    df = spark.createDataFrame(rows, "label double, rawPrediction double")
    assert evaluate.area_under_roc(df) == pytest.approx(3.5 / 4)
