import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.operators import parts, word_tree
from marginalia.operators import word_vectors as wv

TEXT = "doc_id bigint, text array<string>"


@pytest.mark.parametrize("counts", [[(1, 1)], [(1, 2)], [(1, 7), (2, 3), (9, 1)], [(1, 1000), (2, 333), (3, 64), (50, 5), (4000, 1)]])
def test_the_tree_is_as_short_as_one_built_word_by_word(counts):
    tree = word_tree.huffman(counts)
    weights = np.repeat([n for n, _ in counts], [m for _, m in counts])
    inner, path, codes = word_tree.paths(np.arange(len(weights)), tree)
    length = (path < len(inner)).sum(1)
    heap, cost = weights.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (weights * length).sum() == cost and len(inner) == len(weights) - 1
    spelt = {tuple(c[:k][::-1]) for c, k in zip(codes.tolist(), length)}
    assert len(spelt) == len(weights) and sum(2.0 ** -len(c) for c in spelt) == 1.0


@pytest.fixture
def documents(spark):
    """Two sets of words that never meet."""
    rng = random.Random(5)
    rows = [(k, [f"{'ab'[k % 2]}{rng.randrange(8)}" for _ in range(rng.randrange(150, 250))]) for k in range(160)]
    return spark.createDataFrame([*rows, (500, []), (501, ["once", "a1"]), (502, ["nowhere"])], TEXT)


@pytest.mark.parametrize("rounds", [1, 3])
def test_more_words_than_the_driver_should_hold(spark, documents, monkeypatch, rounds):
    monkeypatch.setattr(wv, "DRIVER_WORDS", 3)
    monkeypatch.setattr(parts, "TOKENS_PER_PART", 4000)
    trained = documents.filter("doc_id <> 502").coalesce(1)
    model = wv.fit_word_vectors(trained, vector_size=4, max_iter=rounds)
    assert isinstance(model, word_tree.WordTable)
    words = {r.word: np.array(r.vector) for r in wv.word_vectors(model).collect()}
    assert set(words) == {f"{x}{i}" for x in "ab" for i in range(8)} | {"once"}
    again = {r.word: np.array(r.vector) for r in wv.word_vectors(wv.fit_word_vectors(trained, vector_size=4, max_iter=rounds)).collect()}
    assert all((words[w] == again[w]).all() for w in words)
    unit = {w: v / np.linalg.norm(v) for w, v in words.items()}
    alike = [unit[f"a{i}"] @ unit[f"a{j}"] for i in range(8) for j in range(i)]
    across = [unit[f"a{i}"] @ unit[f"b{j}"] for i in range(8) for j in range(8)]
    assert np.mean(alike) > np.mean(across) + 0.5
    rows = wv.document_vectors(model, documents).collect()
    assert len(rows) == 163 and rows[0].asDict().keys() == {"doc_id", "text", "result"}
    for row in rows:
        mean = sum((words.get(w, np.zeros(4)) for w in row.text), np.zeros(4)) / max(1, len(row.text))
        assert row.result == pytest.approx(list(mean), abs=1e-8)


def test_documents_dealt_before_give_the_same_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(wv, "DRIVER_WORDS", 0)
    rows = documents.unionByName(documents.filter("doc_id < 3")).unionByName(spark.createDataFrame([(None, ["a1"])], TEXT))
    dealt = parts.deal(rows, key="doc_id")
    model = wv.fit_word_vectors(rows, dealt=dealt)
    found = [wv.document_vectors(model, rows, dealt=d).select(F.coalesce("doc_id", F.lit(-1)), "result") for d in (dealt, None)]
    assert sorted(found[0].collect()) == sorted(found[1].collect()) and found[0].count() == 167


def test_min_count_and_null_texts(spark, monkeypatch):
    monkeypatch.setattr(wv, "DRIVER_WORDS", 0)
    documents = spark.createDataFrame([(1, ["a", "a", "b", None]), (2, None), (None, ["a", "b", "c"])], TEXT)
    model = wv.fit_word_vectors(documents, min_count=2)
    assert {r.word for r in wv.word_vectors(model).collect()} == {"a", "b"}
    found = {r.doc_id: r.result for r in wv.document_vectors(model, documents).collect()}
    assert len(found) == 3 and found[2] == [0.0] * 3
