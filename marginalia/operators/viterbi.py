"""Word boundaries of untagged sentences: the best well-formed tag string under counted statistics (Viterbi).

The model is learnt by the aggregates of ``tagging``. Scores are logarithms of add-one shares in whole millionths, so a
path's score is an exact sum. The model holds one score for each tag and character that was seen, which Unicode bounds
at 1.1 million characters (35 MB); it travels with the tasks. Sentences stay where they are: a task steps through all
sentences of a slice side by side, one character a step, with one back pointer of a byte for each character and tag.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marginalia.operators import tagging
from marginalia.operators.tagging import TAGS, TRANSITIONS

UNIT = 1_000_000
#: What no path may do; larger in size than any sum of scores of a string that fits a row.
NEVER = -(1 << 60)
FIRST, LAST = "BS", "ES"
#: Sentences are stepped through together up to this many characters; a longer one goes alone.
SLICE_CHARS = 1 << 20


@dataclass(frozen=True)
class TagModel:
    start: np.ndarray  # by tag
    follow: np.ndarray  # by tag and next tag
    codes: np.ndarray  # code points seen, ascending
    emit: np.ndarray  # by code point seen and tag; the last row is for any other


def _score(part, whole) -> np.ndarray:
    return np.floor(UNIT * np.log(np.asarray(part, float) / np.asarray(whole, float)) + 0.5).astype(np.int64)


def fit(sentences: DataFrame) -> TagModel:
    """The model of ``sentences(sent_id, chars, tags)``; without rows, well-formed strings of a length differ in size of step only."""
    tags = {r.tag: r.n for r in tagging.tag_counts(sentences).collect()}
    first = {r.tag: r.n for r in tagging.start_counts(sentences).collect()}
    pairs = {r.pair: r.n for r in tagging.transition_counts(sentences).collect()}
    cells = tagging.emission_counts(sentences).toArrow()  # at most four rows for each character there is
    start, follow = np.full(4, NEVER), np.full((4, 4), NEVER)
    for t in FIRST:
        start[TAGS.index(t)] = _score(first.get(t, 0) + 1, sum(first.values()) + len(FIRST))
    for pair in TRANSITIONS:
        own = [p for p in TRANSITIONS if p[0] == pair[0]]
        follow[TAGS.index(pair[0]), TAGS.index(pair[1])] = _score(pairs.get(pair, 0) + 1, sum(pairs.get(p, 0) for p in own) + len(own))
    points = np.array([ord(c) for c in cells.column("ch").to_pylist()], np.uint32)
    codes, at = np.unique(points, return_inverse=True)
    counts = np.zeros((len(codes) + 1, 4), np.int64)
    counts[at, [TAGS.index(t) for t in cells.column("tag").to_pylist()]] = cells.column("n").to_numpy()
    totals = np.array([tags.get(t, 0) for t in TAGS]) + len(codes) + 1
    return TagModel(start, follow, codes, _score(counts + 1, totals))


def model_table(spark: SparkSession, model: TagModel) -> DataFrame:
    """``(kind, tag, key, score)``: kind ``start``; ``follow`` with the next tag; ``emit`` with the character, '' any other."""
    chars = [*map(chr, model.codes), ""]
    rows = [("start", t, "", int(model.start[TAGS.index(t)])) for t in FIRST]
    rows += [("follow", p[0], p[1], int(model.follow[TAGS.index(p[0]), TAGS.index(p[1])])) for p in TRANSITIONS]
    rows += [("emit", t, c, int(s)) for c, own in zip(chars, model.emit) for t, s in zip(TAGS, own)]
    return spark.createDataFrame(rows, "kind string, tag string, key string, score bigint")


def tag(sentences: DataFrame, model: TagModel) -> DataFrame:
    """Add ``tags`` and their ``score`` to ``sentences(chars, ...)``; what stood in such columns goes.

    Of equal paths, the one whose last tag, then last but one and so on, comes first in B, M, E, S. An empty sentence has
    no tags and score 0; both are null for a null.
    """
    given = sentences.drop("tags", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("chars").to_pylist()
            tags, scores = [None] * len(texts), [None] * len(texts)
            for group in _slices(texts):
                for i, found, score in zip(group, *best_paths([texts[i] for i in group], model)):
                    tags[i], scores[i] = found, score
            yield batch.append_column("tags", pa.array(tags, pa.string())).append_column("score", pa.array(scores, pa.int64()))

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in given.schema.fields)
    return given.mapInArrow(run, f"{fields}, tags string, score bigint")


def _slices(texts: list[str | None]) -> Iterator[list[int]]:
    """Positions of the texts that are not null, of like length together, in slices."""
    held, size = [], 0
    for i in sorted((i for i, t in enumerate(texts) if t is not None), key=lambda i: -len(texts[i])):
        if held and size + len(texts[i]) > SLICE_CHARS:
            yield held
            held, size = [], 0
        held.append(i)
        size += len(texts[i])
    if held:
        yield held


def best_paths(texts: list[str], model: TagModel) -> tuple[list[str], list[int]]:
    """Best tag strings of ``texts``, longest first, and the scores those strings have."""
    lengths = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.cumsum(lengths) - lengths
    at = np.searchsorted(model.codes, codes)
    known = np.append(model.codes, 0)[at] == codes if len(model.codes) else np.zeros(len(codes), bool)
    emit = model.emit[np.where(known & (at < len(model.codes)), at, len(model.codes))]
    some = int((lengths > 0).sum())
    score = model.start + emit[offsets[:some]]
    back = np.zeros((len(codes), 4), np.int8)
    # Texts get no longer along the list, so those with a character at a step are its head.
    alive = [int(n) for n in np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")]
    for step, n in enumerate(alive[1:], 1):
        options = score[:n, :, None] + model.follow
        before = options.argmax(axis=1)
        back[offsets[:n] + step] = before
        score[:n] = np.take_along_axis(options, before[:, None, :], 1)[:, 0] + emit[offsets[:n] + step]
    ends = np.array([t in LAST for t in TAGS])
    current = np.where(ends, score, 2 * NEVER).argmax(axis=1)
    path = np.zeros(len(codes), np.int8)
    for step in range(len(alive) - 1, -1, -1):
        n = alive[step]
        path[offsets[:n] + step] = current[:n]
        current[:n] = back[offsets[:n] + step, current[:n]]
    letters = np.frombuffer("".join(TAGS).encode(), np.uint8)[path].tobytes().decode()
    gains = emit[np.arange(len(codes)), path] + np.append(0, model.follow[path[:-1], path[1:]])[: len(codes)]
    gains[offsets[:some]] = emit[offsets[:some], path[offsets[:some]]] + model.start[path[offsets[:some]]]
    sums = np.append(0, np.cumsum(gains))
    return [letters[o : o + k] for o, k in zip(offsets, lengths)], (sums[offsets + lengths] - sums[offsets]).tolist()
