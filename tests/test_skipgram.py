import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marginalia.operators import skipgram

TEXT = "doc_id bigint, text array<string>"


@pytest.fixture(scope="module")
def documents(spark):
    """Two sets of words that never meet, with a few words of their own."""
    rng = random.Random(3)
    rows = []
    for k in range(120):
        words = [f"{'ab'[k % 2]}{rng.randrange(6)}" for _ in range(rng.randrange(2, 15))]
        rows.append((k, words + [f"own{k}"] * (k % 9 == 0)))
    return spark.createDataFrame(rows + [(500, []), (501, None), (502, ["a1", None, "a2"])], TEXT)


def test_window_pairs(documents):
    expected = Counter()
    for row in documents.collect():
        words = row.text or []
        for i, a in enumerate(words):
            for b in words[max(0, i - 2) : i] + words[i + 1 : i + 3]:
                if a is not None and b is not None:
                    expected[a, b] += 1
    assert {(r.word, r.context): r.n for r in skipgram.window_pairs(documents, 2).collect()} == expected


def test_numbers_are_dense(spark, monkeypatch):
    monkeypatch.setattr(skipgram, "NUMBER_BUCKETS", 7)
    rows = skipgram.numbered(spark.range(500).select(F.col("id").cast("string").alias("word"))).collect()
    assert sorted(r.number for r in rows) == list(range(500)) and {r.words for r in rows} == {500}


def test_vectors_do_not_depend_on_partitions(documents):
    found = [
        sorted(tuple(r) for r in skipgram.train(documents.repartition(parts), epochs=3).collect()) for parts in (1, 4, 8)
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) > 12


def test_loss_falls_and_words_of_one_kind_come_together(documents):
    def loss(epochs):
        parameters = skipgram.train(documents, min_count=2, epochs=epochs, step=2.0)
        pairs = skipgram.window_pairs(documents)
        given = skipgram.examples(pairs.filter("word not like 'own%' and context not like 'own%'"), parameters, 99, 5)
        return skipgram.mean_loss(given, parameters, 3).first().loss

    losses = [loss(epochs) for epochs in (0, 2, 8, 20)]
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.8 * losses[0]


def test_document_vectors(spark, documents):
    parameters = skipgram.train(documents, min_count=2)
    vectors = {r.word: [r.v_0, r.v_1, r.v_2] for r in parameters.collect()}
    assert "own0" not in vectors
    texts = {r.doc_id: r.text or [] for r in documents.collect()}
    got = skipgram.document_vectors(documents, parameters, "doc_id", 3).collect()
    assert len(got) == len(texts)
    for row in got:
        words = [w for w in texts[row.doc_id] if w is not None]
        mean = [sum(vectors.get(w, [0] * 3)[i] for w in words) / max(1, len(words)) for i in range(3)]
        assert [row.r_0, row.r_1, row.r_2] == pytest.approx(mean, abs=1e-8)


def test_no_documents_and_no_counter_examples(spark, documents):
    assert skipgram.train(spark.createDataFrame([], TEXT)).collect() == []
    assert skipgram.train(documents, negatives=0, epochs=1).count() > 12
