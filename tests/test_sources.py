import pytest
from pyspark.sql import functions as F

from marginalia.functions.text import letter_counts, space_tokens
from marginalia.sources import labelled
from marginalia.sources.corpora import numbered_lines, read_tagged_corpus
from marginalia.sources.tables import spread

from samples import LOANS, SENTENCES

MEASURES = ["sepal_length", "sepal_width", "petal_length", "petal_width"]


@pytest.fixture
def flowers(spark, tmp_path):
    path = tmp_path / "flowers.data"
    path.write_text("5.1,3.5,1.4,0.2,setosa\n7.0,3.2,4.7,1.4,versicolor\n4.9,3.0,1.4,0.2,setosa")
    return labelled.read_measurements(spark, str(path), MEASURES)


def test_measurements(flowers):
    assert flowers.dtypes == [(m, "double") for m in MEASURES] + [("species", "string")]
    points = labelled.with_features(labelled.with_label(flowers, "species"), MEASURES)
    rows = points.orderBy("sepal_length").select("label", "features").collect()
    assert [r.label for r in rows] == [0.0, 0.0, 1.0]
    assert list(rows[2].features) == [7.0, 3.2, 4.7, 1.4]


def test_broken_measurements_fail(spark, tmp_path):
    path = tmp_path / "broken.data"
    path.write_text("5.1,3.5,1.4,0.2,setosa\n5.1,many,1.4,0.2,setosa\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        labelled.read_measurements(spark, str(path), MEASURES).collect()


def test_label_index(flowers):
    rows = labelled.label_index(flowers, "species").collect()
    assert sorted(map(tuple, rows)) == [("setosa", 0.0, 2), ("versicolor", 1.0, 1)]


def test_unknown_or_missing_class_fails(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert labelled.label_names(df, "c") == ["a"]
    with pytest.raises(Exception, match="unknown class"):
        labelled.with_label(df, "c").collect()
    with pytest.raises(Exception, match="unknown class: b"):
        labelled.with_label(spark.createDataFrame([("b",)], "c string"), "c", ["a"]).collect()


def test_class_columns_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(labelled, "MAX_CLASSES", 3)
    with pytest.raises(ValueError, match="not a class column"):
        labelled.label_names(spark.range(4).withColumn("c", F.col("id").cast("string")), "c")


def test_inline(spark):
    points = labelled.inline_points(spark, LOANS)
    assert points.count() == 15 and points.filter("label = 1").count() == 9
    texts = [r.text for r in labelled.inline_documents(spark, SENTENCES).collect()]
    assert [len(t) for t in texts] == [5, 7, 5] and len({w for t in texts for w in t}) == 16


@pytest.mark.parametrize(
    "text, expected",
    [("a b  ", ["a", "b"]), (" a  b", ["", "a", "", "b"]), ("", [""]), ("  ", []), ("a\tb", ["a\tb"]), (None, None)],
)
def test_space_tokens(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(space_tokens(F.col("t"))).first()[0] == expected


def test_letter_counts(spark):
    df = spark.createDataFrame([("Aabéaé",), ("",)], "t string").select(*letter_counts(F.col("t"), ["a", "b"]))
    assert sorted(map(tuple, df.collect())) == [(0.0, 0.0), (2.0, 1.0)]


def test_spread_only_small_inputs(spark):
    assert spread(spark.range(10).coalesce(1), "id").rdd.getNumPartitions() == 4
    many = spark.range(0, 10, 1, 6)
    assert spread(many, "id") is many


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_numbered_lines(spark, tmp_path, small_splits):
    folder = tmp_path / "lines"
    folder.mkdir()
    first = [f"a{i}" + "x\r" * (i % 17) for i in range(200)]
    second = [f"b{i}" for i in range(50)]
    (folder / "1.txt").write_bytes("\n".join(first).encode())
    (folder / "2.txt").write_text("\n".join(second))
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
    lines = numbered_lines(spark, str(folder))
    got = [r.value for r in lines.orderBy("line_no").collect()]
    assert got == first + second
    assert [r.line_no for r in lines.orderBy("line_no").collect()] == list(range(250))


def test_tagged_corpus(spark, tmp_path, small_splits):
    chars = ["看山川河", "好天气", "雨"] * 30
    tags = ["SBME", "BME", "S"] * 30
    (tmp_path / "chars.txt").write_text("\n".join(chars), encoding="utf-8")
    (tmp_path / "tags.txt").write_text("\n".join(tags))
    corpus = read_tagged_corpus(spark, str(tmp_path / "chars.txt"), str(tmp_path / "tags.txt"))
    assert [tuple(r) for r in corpus.orderBy("sent_id").collect()] == list(zip(range(90), chars, tags))


@pytest.mark.parametrize("tags", ["SBME\nBE", "SBME", "SBME\nBME\nS"])
def test_unaligned_corpus_fails(spark, tmp_path, tags):
    (tmp_path / "chars.txt").write_text("看山川河\n好天气", encoding="utf-8")
    (tmp_path / "tags.txt").write_text(tags)
    with pytest.raises(Exception, match="without equally long partner"):
        read_tagged_corpus(spark, str(tmp_path / "chars.txt"), str(tmp_path / "tags.txt")).collect()
