import random

import numpy as np
import pytest

from marginalia.operators import parts, skipgram

TEXT = "doc_id bigint, text array<string>"


@pytest.mark.parametrize("values", [[], [-1, 0, 7, 70_000, -1], list(range(3000))])
def test_packed_numbers_come_back(values):
    assert parts.unpack(parts.pack(np.array(values, np.int32))).tolist() == values


def test_parts_hold_all_tokens_in_order(spark, monkeypatch):
    monkeypatch.setattr(parts, "TOKENS_PER_PART", 5)
    rows = [(1, ["a", None, "b", "a"]), (None, None), (1, []), (3, ["", "ü", "a"]), (4, ["b"] * 9)]
    dealt = parts.in_parts(spark.createDataFrame(rows, TEXT).coalesce(1), key="doc_id").collect()
    found = []
    for part in dealt:
        words = [*part.words, None]
        tokens, ends = [words[i] for i in parts.unpack(part.ids)], np.cumsum(parts.unpack(part["sizes"]))
        found += [(k, tokens[e - s : e]) for k, s, e in zip(part["keys"], parts.unpack(part["sizes"]), ends)]
        assert sorted(part.counts, reverse=True) == part.counts and sum(part.counts) == sum(t is not None for t in tokens)
    key = lambda r: (r[0] or 0, len(r[1]))
    assert sorted(found, key=key) == sorted(((k, t or []) for k, t in rows), key=key)


def test_training_writes_rows_by_word_not_by_pair(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(k, [f"w{rng.randrange(60)}" for _ in range(200)]) for k in range(40)]
    written, plain = [], skipgram.staged

    def counting(table):
        kept = plain(table)
        written.append(kept.count())
        return kept

    monkeypatch.setattr(skipgram, "staged", counting)
    documents = spark.createDataFrame(rows, TEXT)
    assert skipgram.train(documents, epochs=1).count() == 60
    assert skipgram.window_pairs(documents).count() > 3000 and max(written) <= 60 * spark.sparkContext.defaultParallelism


def test_a_step_equals_the_step_over_counted_pairs(spark):
    rng = random.Random(2)
    rows = [(k, [rng.choice(["a", "b", "c", "d", "rare" + str(k), None]) for _ in range(12)]) for k in range(30)] + [(99, ["alone"] * 5)]
    documents = spark.createDataFrame(rows, TEXT)
    after = skipgram.train(documents, min_count=2, epochs=2, negatives=2, window_size=3)
    known = [r.word for r in after.collect()]
    expected = skipgram.train(documents, min_count=2, epochs=0)
    pairs = skipgram.window_pairs(documents, 3).filter(f"word in {tuple(known)} and context in {tuple(known)}")
    for epoch in range(2):
        expected = skipgram.next_parameters(expected, skipgram.examples(pairs, expected, epoch, 2), 3, 1.0)
    for got, want in zip(sorted(after.collect()), sorted(expected.collect())):
        assert got.word == want.word and list(got)[3:] == pytest.approx(list(want)[3:], abs=1e-10)
