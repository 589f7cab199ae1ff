import numpy as np
import pytest

from marginalia.operators import word_vectors as wv
from marginalia.sources.labelled import inline_documents

from samples import SENTENCES


@pytest.fixture
def documents(spark):
    return inline_documents(spark, SENTENCES)


def test_document_vector_is_the_mean_of_its_words(documents):
    model = wv.fit_word_vectors(documents)
    words = {r.word: np.array(r.vector) for r in wv.word_vectors(model).collect()}
    assert len(words) == 16
    for row in wv.document_vectors(model, documents).collect():
        assert row.result == pytest.approx(list(np.mean([words[w] for w in row.text], axis=0)), abs=1e-6)


def test_seed_repeats_on_one_partition(documents):
    first, second = (wv.document_vectors(wv.fit_word_vectors(documents, seed=7), documents).collect() for _ in range(2))
    assert first == second


def test_unknown_words_count_in_the_denominator(spark):
    documents = spark.createDataFrame([(["a", "a", "b", "c"],), (["a", "b", "zz"],), (["q"],), ([],)], "text array<string>")
    model = wv.fit_word_vectors(documents, min_count=2)
    words = {r.word: np.array(r.vector) for r in wv.word_vectors(model).collect()}
    assert set(words) == {"a", "b"}
    got = {tuple(r.text): r.result for r in wv.document_vectors(model, documents).collect()}
    assert got["a", "a", "b", "c"] == pytest.approx(list((2 * words["a"] + words["b"]) / 4), abs=1e-6)
    assert got["q",] == [0.0] * 3 and got[()] == [0.0] * 3


def test_vocabulary(documents):
    assert {(r.word, r.n) for r in wv.vocabulary(documents, 2).collect()} == {("I", 2)}


def test_too_large_a_model_is_refused(documents, monkeypatch):
    monkeypatch.setattr(wv, "MODEL_BYTES", 8 * 16 * 3 - 1)
    with pytest.raises(ValueError, match="raise min_count"):
        wv.fit_word_vectors(documents)
