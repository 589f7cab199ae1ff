"""Skip-gram vectors with hierarchical softmax for vocabularies that the driver should not hold.

The method is that of Spark ML's Word2Vec: a Huffman tree over the words' counts, linear decay of the learning rate, sentences
of at most 1000 known words, a random window for each place; parts train side by side from one state, and each
word's vectors (and each inner node's, if there is another round) are averaged over the parts that hold it. What differs is
where things are: documents are in parts (``parts``), words and vectors in tables. The driver sees how many words there
are of each count, and tasks the tree as runs of nodes whose parents are consecutive, both of about the size of the
different counts. A task takes steps of ``PLACES`` consecutive words, whose updates are computed from one state and added up.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.keys import hash_bucket
from marginalia.operators.parts import Dealt, rows_of_words, unpack, with_parts
from marginalia.operators.staging import staged

LEARNING_RATE = 0.025
SENTENCE = 1000
#: Beyond this, a score's step is left out, as in Word2Vec.
MAX_SCORE = 6.0
PLACES = 32
#: Vectors are averaged in steps of 2**-32.
VECTOR_BITS = 32
#: Words that occur at most ``RARE`` times are numbered in this many buckets for each count, others in one.
RARE, BUCKETS = 100, 1024


@dataclass(frozen=True)
class WordTable:
    """A trained model: ``vectors`` is ``(word, v_0, v_1, ...)``."""

    vectors: DataFrame
    vector_size: int


@dataclass(frozen=True)
class Tree:
    """Node k of the run that starts at or last before it hangs on ``parents + (codes + k - starts) // 2``."""

    starts: np.ndarray
    parents: np.ndarray
    codes: np.ndarray
    root: int

    def above(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parent and code of each node; the root is its own parent."""
        if not len(self.starts):
            return nodes, np.zeros_like(nodes)
        run = np.maximum(np.searchsorted(self.starts, nodes, "right") - 1, 0)
        place = self.codes[run] + nodes - self.starts[run]
        top = nodes == self.root
        return np.where(top, nodes, self.parents[run] + place // 2), np.where(top, 0, place % 2)


def huffman(counts: Sequence[tuple[int, int]]) -> Tree:
    """The tree over leaves numbered by count, of which ``counts(n, words)`` tells how many there are; inner nodes follow.

    Equal nodes in a row are paired all at once, so the work goes with the number of different counts.
    """
    heap, number, rows = [], 0, []
    for n, words in sorted(counts):
        heap.append((n, number, words))
        number += words
    heapq.heapify(heap)
    while heap:
        n, first, size = heapq.heappop(heap)
        if size > 1:
            half = size // 2
            rows.append((first, number, 0))
            heapq.heappush(heap, (2 * n, number, half))
            number += half
            if size % 2:
                heapq.heappush(heap, (n, first + 2 * half, 1))
        elif heap:
            other, second, more = heapq.heappop(heap)
            rows += [(first, number, 0), (second, number, 1)]
            heapq.heappush(heap, (n + other, number, 1))
            number += 1
            if more > 1:
                heapq.heappush(heap, (other, second + 1, more - 1))
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return Tree(*(np.ascontiguousarray(c) for c in table.T), root=number - 1)


def leaves(words: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """``(word, leaf)`` of ``words(word, n)``, numbered from 0 by count, and how many words there are of each count."""
    counts = [(r.n, r.words) for r in words.groupBy("n").agg(F.count("*").alias("words")).orderBy("n").collect()]
    firsts = np.cumsum([0, *(m for _, m in counts)])[:-1].tolist()
    starts = words.sparkSession.createDataFrame([(n, f) for (n, _), f in zip(counts, firsts)], "n bigint, first bigint")
    bucket = F.when(F.col("n") <= RARE, hash_bucket(F.col("word"), BUCKETS)).otherwise(0)
    parted = words.withColumn("bucket", bucket)
    sizes = parted.groupBy("n", "bucket").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("n").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("n", "bucket", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("n", "bucket").orderBy("word")) - 1
    placed = parted.withColumn("place", place).join(offsets, ["n", "bucket"]).join(F.broadcast(starts), "n")
    return placed.select("word", (F.col("first") + F.col("before") + F.col("place")).alias("leaf")), counts


def first_vectors(leaf: np.ndarray, vector_size: int, seed: int) -> np.ndarray:
    """Within half a unit over the size, by a hash of number, place and seed."""
    with np.errstate(over="ignore"):
        x = (leaf[:, None] * vector_size + np.arange(vector_size)).astype(np.uint64)
        x += np.uint64(seed % (1 << 32) + 1) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return ((x / 2.0**64 - 0.5) / vector_size).astype(np.float32)


def paths(leaf: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inner nodes above the leaves; by leaf, its path as places among them, one beyond where it has ended; the codes."""
    levels, at = [], np.unique(leaf)
    while len(at := np.unique(tree.above(at[at != tree.root])[0])):
        levels.append(at)
    nodes = np.unique(np.concatenate(levels)) if levels else np.zeros(0, np.int64)
    up, bits = tree.above(nodes)
    up = np.append(np.searchsorted(nodes, up), len(nodes)).astype(np.int32)
    up[:-1][nodes == tree.root] = len(nodes)
    bits = np.append(bits, 0).astype(np.int8)
    first, code = tree.above(leaf)
    at = np.where(leaf == tree.root, len(nodes), np.searchsorted(nodes, first)).astype(np.int32)
    places, codes, code = [], [], code.astype(np.int8)
    while (at < len(nodes)).any():
        places.append(at)
        codes.append(code)
        at, code = up[at], bits[at]
    if not places:
        return nodes, np.zeros((len(leaf), 0), np.int32), np.zeros((len(leaf), 0), np.int8)
    return nodes, np.stack(places, 1), np.stack(codes, 1)


def train_part(
    tokens: np.ndarray, sizes: np.ndarray, path: np.ndarray, codes: np.ndarray, words: np.ndarray, nodes: np.ndarray,
    window_size: int, done: float, rounds: int, rng: np.random.Generator,
) -> None:
    """One pass over ``tokens`` (-1: unknown) that changes ``words`` and ``nodes``; the last of ``nodes`` ends the paths."""
    text = np.repeat(np.arange(len(sizes)), sizes)[tokens >= 0]
    tokens = tokens[tokens >= 0]
    begin = np.searchsorted(text, text)  # a sentence ends with its text, or after SENTENCE known words
    sentence = text * (1 << 32) + (np.arange(len(text)) - begin) // SENTENCE
    lengths = (path < len(nodes) - 1).sum(1)
    around = [d for d in range(-window_size, window_size + 1) if d]
    offsets, apart = np.array(around) + window_size, np.abs(around)
    padded = np.pad(tokens, window_size)
    padded_sentence = np.pad(sentence, window_size, constant_values=-1)
    lanes = np.arange(words.shape[1])
    flat_words, flat_nodes = words.reshape(-1), nodes.reshape(-1)
    for start in range(0, len(tokens), PLACES):
        centre = tokens[start : start + PLACES]
        deep = lengths[centre].max()
        rate = LEARNING_RATE * max(1e-4, 1.0 - (done + start / len(tokens)) / rounds)
        where = np.arange(start, start + len(centre))[:, None] + offsets
        near = apart <= rng.integers(1, window_size + 1, len(centre))[:, None]
        near &= padded_sentence[where] == sentence[start : start + len(centre), None]
        context, node = padded[where], path[centre, :deep]
        x, y = words[context], nodes[node]
        score = x @ y.transpose(0, 2, 1)
        step = (1.0 - codes[centre, :deep].astype(np.float32))[:, None] - 1.0 / (1.0 + np.exp(-np.clip(score, -MAX_SCORE, MAX_SCORE)))
        step *= near[:, :, None] & (node < len(nodes) - 1)[:, None] & (np.abs(score) < MAX_SCORE)
        step *= np.float32(rate)
        to_words, to_nodes = step @ y, step.transpose(0, 2, 1) @ x
        np.add.at(flat_words, (context[..., None] * len(lanes) + lanes).ravel(), to_words.ravel())
        np.add.at(flat_nodes, (node[..., None] * len(lanes) + lanes).ravel(), to_nodes.ravel())


def fit(dealt: Dealt, counts: DataFrame, vector_size: int, window_size: int, rounds: int, seed: int) -> WordTable:
    """Vectors of the known words of ``dealt``, of which ``counts(word, n)`` tells how often each occurs."""
    numbers, histogram = leaves(counts)
    numbers = staged(numbers)
    tree = huffman(histogram)
    n_words = sum(m for _, m in histogram)
    places = staged(dealt.known.select("part", "at", "word").join(numbers, "word").select("part", "at", F.col("leaf").alias("id")))
    xs = [f"v_{i}" for i in range(vector_size)]
    one = float(1 << VECTOR_BITS)
    rows, state = places, None
    for done in range(rounds):

        def run(part: dict, rows: dict, done: int = done) -> dict:
            own = {c: v[rows["at"] >= 0] for c, v in rows.items()}
            inner, path, codes = paths(own["id"], tree)
            if done:
                words = np.stack([own[x] for x in xs], 1).astype(np.float32)
                order = np.argsort(rows["id"][rows["at"] < 0])
                nodes = np.stack([rows[x][rows["at"] < 0][order] for x in xs], 1).astype(np.float32)
            else:
                words, nodes = first_vectors(own["id"], vector_size, seed), np.zeros((len(inner), vector_size), np.float32)
            nodes = np.concatenate([nodes, np.zeros((1, vector_size), np.float32)])
            rng = np.random.default_rng([seed % (1 << 32), done, part["part"].as_py()])
            tokens = rows_of_words(part, own)
            if path.shape[1]:
                train_part(tokens, unpack(part["sizes"].as_py()), path, codes, words, nodes, window_size, done, rounds, rng)
            ids = own["id"]
            if done + 1 < rounds:
                ids, words = np.concatenate([ids, inner]), np.concatenate([words, nodes[:-1]])
            fixed = np.floor(words.astype(np.float64) * one + 0.5).astype(np.int64)
            return {"part": np.full(len(ids), part["part"].as_py()), "id": ids, **{x: fixed[:, i] for i, x in enumerate(xs)}}

        schema = ", ".join(["part bigint", "id bigint", *(f"{x} bigint" for x in xs)])
        found = with_parts(dealt.parts, rows, run, schema, "ids", "sizes")
        last = done + 1 == rounds
        found = found if last else staged(found)
        means = [(F.sum(x) / F.count("*") / one).alias(x) for x in xs]
        state = staged(found.groupBy("id").agg(*means))
        if not last:
            inner_rows = found.filter(F.col("id") >= n_words).select("part", F.lit(-1).cast("int").alias("at"), "id")
            rows = places.unionByName(inner_rows).join(state, "id").select("part", "at", "id", *xs)
    return WordTable(numbers.join(state, numbers["leaf"] == state["id"]).select("word", *xs), vector_size)
