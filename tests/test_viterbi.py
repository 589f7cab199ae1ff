import itertools
import random
import re

import numpy as np
import pytest

from marginalia.operators import tagging, viterbi

TRAINING = [(0, "abcab", "BESBE"), (1, "abca", "BMES"), (2, "cabxyz", "SBEBME"), (3, "aa", "SS"), (4, "", "")]
SCHEMA = "sent_id bigint, chars string, tags string"


@pytest.fixture(scope="module")
def model(spark):
    return viterbi.fit(spark.createDataFrame(TRAINING, SCHEMA))


def value(chars, tags, model):
    if not chars:
        return 0
    at = [tagging.TAGS.index(t) for t in tags]
    known = {chr(c): i for i, c in enumerate(model.codes)}
    emitted = sum(int(model.emit[known.get(c, -1), t]) for c, t in zip(chars, at))
    return int(model.start[at[0]]) + emitted + sum(int(model.follow[a, b]) for a, b in zip(at, at[1:]))


def best(chars, model):
    """Of all well-formed tag strings the best, ties to the one whose reverse comes first."""
    paths = [p for p in itertools.product(range(4), repeat=len(chars)) if re.fullmatch("(S|BM*E)*", "".join(tagging.TAGS[t] for t in p))]
    named = [("".join(tagging.TAGS[t] for t in p), p[::-1]) for p in paths]
    return min(((-value(chars, tags, model), order, tags) for tags, order in named), default=(0, (), ""))


def test_model_counts(model):
    assert model.start[[1, 2]].tolist() == [viterbi.NEVER] * 2
    assert model.start[0] == round(1e6 * np.log(3 / 6)) and model.start[3] == round(1e6 * np.log(3 / 6))
    assert "".join(map(chr, model.codes)) == "abcxyz" and model.emit.shape == (7, 4)
    # B stands 5 times, 4 of them at an "a"; there are seven places for characters.
    assert model.emit[0, 0] == round(1e6 * np.log(5 / 12)) and model.emit[-1, 0] == round(1e6 * np.log(1 / 12))


def test_best_of_all_tag_strings(spark, model):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcxyz?é\U0001f600") for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    texts += ["", None, "?", "??", "????"]
    df = spark.createDataFrame([(i, t, "old", 1.5) for i, t in enumerate(texts)], "sent_id bigint, chars string, score string, `a b` double")
    found = viterbi.tag(df.repartition(3), model)
    assert found.columns == ["sent_id", "chars", "a b", "tags", "score"]
    for r in found.collect():
        if r.chars is None:
            assert r.tags is None and r.score is None
            continue
        negative, _, tags = best(r.chars, model)
        assert (r.tags, r.score) == (tags, -negative), r.chars


def test_without_training_rows(spark):
    model = viterbi.fit(spark.createDataFrame([], SCHEMA))
    got = viterbi.tag(spark.createDataFrame([(0, "abc")], "sent_id bigint, chars string"), model).first()
    assert got.tags == best("abc", model)[2]
    assert viterbi.tag(spark.createDataFrame([], "sent_id bigint, chars string"), model).count() == 0


def test_long_and_many_sentences_come_out_as_each_alone(spark, model, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcxyz") for _ in range(n)) for n in (200_000, 50, 50, 1, 700)]
    order = sorted(texts, key=len, reverse=True)
    together = viterbi.best_paths(order, model)
    assert [len(t) for t in together[0]] == [len(t) for t in order]
    for text, tags, score in zip(order, *together):
        assert viterbi.best_paths([text], model) == ([tags], [score])
        assert score == value(text, tags, model)
    groups = list(viterbi._slices([*texts, None, ""]))
    assert sorted(i for g in groups for i in g) == [0, 1, 2, 3, 4, 6]
    rows = [(0, text, tags) for text, tags in zip(order, together[0])]
    assert tagging.decode(spark.createDataFrame(rows, SCHEMA)).count() == 5
