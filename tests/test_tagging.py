import os
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.operators import tagging
from marginalia.sources.corpora import read_tagged_corpus

ROWS = [(0, "将物联网", "SBME"), (1, "大数据", "BME"), (2, "新的大数据平台", "SSBMEBE"), (3, "", "")]


@pytest.fixture
def sentences(spark):
    return spark.createDataFrame(ROWS, "sent_id bigint, chars string, tags string")


def test_decode(sentences):
    got = [r.words for r in tagging.decode(sentences).orderBy("sent_id").collect()]
    assert got == [["将", "物联网"], ["大数据"], ["新", "的", "大数据", "平台"], []]


def test_characters(sentences):
    got = [tuple(r) for r in tagging.tagged_characters(sentences).orderBy("sent_id", "pos").collect()]
    assert got == [(i, p, c, t) for i, chars, tags in ROWS for p, (c, t) in enumerate(zip(chars, tags))]


def test_statistics(sentences):
    tags = [r[2] for r in ROWS]
    as_dict = lambda df: {tuple(r)[:-1]: r[-1] for r in df.collect()}
    assert as_dict(tagging.tag_counts(sentences)) == {(t,): n for t, n in Counter("".join(tags)).items()}
    assert as_dict(tagging.start_counts(sentences)) == {("S",): 2, ("B",): 1}
    pairs = Counter(a + b for t in tags for a, b in zip(t, t[1:]))
    assert as_dict(tagging.transition_counts(sentences)) == {(p,): n for p, n in pairs.items()}
    emitted = Counter((t, c) for _, chars, tags in ROWS for c, t in zip(chars, tags))
    assert as_dict(tagging.emission_counts(sentences)) == dict(emitted)


@pytest.mark.parametrize(
    "chars, tags",
    [("abcd", "SBMS"), ("abc", "MES"), ("abc", "SSB"), ("abc", "BBE"), ("abc", "SXE"), ("ab", "SBE"), ("abc", None)],
)
def test_malformed_tags_fail(spark, chars, tags):
    df = spark.createDataFrame([(0, chars, tags)], "sent_id bigint, chars string, tags string")
    for statistic in (tagging.decode, tagging.tag_counts, tagging.tagged_characters):
        with pytest.raises(Exception, match="tags must be"):
            statistic(df).collect()


def test_long_sentences(spark):
    words = ["ab", "c", "def"] * 20_000
    df = spark.createDataFrame([(0, words)], "sent_id bigint, words array<string>")
    encoded = df.select("sent_id", *tagging.encode(F.col("words")))
    assert tagging.decode(encoded).first().words == words


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cc"]), max_size=5), max_size=6), min_size=1, max_size=6))
def test_decode_undoes_encode(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "sent_id bigint, words array<string>")
    encoded = df.select("sent_id", *tagging.encode(F.col("words")))
    got = [r.words for r in tagging.decode(encoded).orderBy("sent_id").collect()]
    assert got == [[w for w in words if w] for words in lists]


def test_corpus_files(spark):
    paths = [os.environ.get(name) for name in ("CORPUS_CHARS", "CORPUS_TAGS")]
    if not all(paths):
        pytest.skip("CORPUS_CHARS and CORPUS_TAGS name no files")
    corpus = read_tagged_corpus(spark, *paths)
    assert {r.tag: r.n for r in tagging.tag_counts(corpus).collect()} == {"B": 129, "M": 31, "E": 129, "S": 39}
    assert {r.tag: r.n for r in tagging.start_counts(corpus).collect()} == {"B": 26, "S": 8}
    assert {r.pair: r.n for r in tagging.transition_counts(corpus).collect()} == {
        "BE": 110, "BM": 19, "MM": 12, "ME": 19, "EB": 68, "ES": 28, "SB": 35, "SS": 3,
    }
    words = [w for r in tagging.decode(corpus).collect() for w in r.words]
    assert (len(words), len(set(words))) == (168, 114)
    assert tagging.decode(corpus).filter("sent_id = 1").first().words == ["将", "物联网"]
