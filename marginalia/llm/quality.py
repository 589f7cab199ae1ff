"""Quality classifier from weak labels.

Heuristic labellers each look at a whole text and vote good, bad or nothing. Expectation-maximisation over how
often each pattern of votes occurs in the corpus estimates how often each labeller is right on either class (Dawid
and Skene), without any true label. The posterior of a pattern labels the texts that have it, and these labels train
a linear scorer on hashed byte triples and runs of kinds of bytes, which then scores every text.

The votes of all rows are counted; the pattern table has at most 3 ** len(LABELLERS) rows, so it fits the driver.
The scorer is fitted on a sample of about ``train_rows`` rows, drawn by hash of id and text (a documented bound);
the driver gets their hashed features and nothing else. Every row is scored.

A null or empty text gets votes like any other (bad from the labeller of length) and is scored by the bias. A null id is
handed on; repeated rows get the same score; an empty table gives an empty table. If the corpus shows only one
kind of votes, the posterior is that of the votes and the scorer follows it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import WORD_BYTES, arrow_schema, batches_of, id_and_text

BUCKETS = 1 << 13
TRAIN_ROWS = 3000
#: Texts of this many bytes count half.
CERTAIN_BYTES = 40
#: P(bad, good vote | bad text) and the same for good texts before the first round.
FIRST_GUESS, ROUNDS = ((0.3, 0.7), (0.01, 0.99)), 100
KEEP = 0.5
#: Frequent short words of the corpus's languages (fixed values).
FUNCTION_WORDS = frozenset(
    "the of and to in is it that was for on with as at by an be are this from or not "
    "le la les de des du et en un une est que qui dans pour sur au par avec "
    "der die das und zu den von mit ist ein eine nicht auf im dem für sich "
    "el los las del y que en un una por con se para es lo su no al".split()
)
FUNCTION_BYTES = frozenset(w.encode() for w in FUNCTION_WORDS)
#: A blank-separated token of ASCII marks only.
BARE = re.compile(rb"(?<![^ \n])[!-/:-@\[-`{-~]+(?![^ \n])")


class Facts:
    """What the labellers look at: a text's bytes by value, its blank-separated tokens, its words."""

    def __init__(self, text: str | None):
        self.raw = (text or "").encode()
        self.bytes = np.bincount(np.frombuffer(self.raw, np.uint8), minlength=256)
        self.tokens = self.raw.split()
        self.n = len(self.tokens)

    def count(self, characters: str) -> int:
        return int(self.bytes[list(characters.encode())].sum())

    def share(self, hits: float) -> float:
        return hits / self.n if self.n else 0.0


def _vote(value: float, good: float, bad: float) -> int:
    """1 at or below ``good``, -1 at or above ``bad``, else 0."""
    return 1 if value <= good else -1 if value >= bad else 0


def symbols(f: Facts) -> int:
    return _vote(f.count("#$%&*|@^~<>{}=_\\") / max(1, len(f.raw)), 0.01, 0.04)


def symbols_per_token(f: Facts) -> int:
    return _vote(f.share(f.count("#$%&*|^~<>{}=_\\")), 0.1, 0.3)


def upper_case(f: Facts) -> int:
    upper, lower = int(f.bytes[65:91].sum()), int(f.bytes[97:123].sum())
    return _vote(upper / max(1, upper + lower), 0.15, 0.3)


def exclamations(f: Facts) -> int:
    return _vote(f.share(f.count("!")), 0.1, 0.25)


def repeats_in_a_row(f: Facts) -> int:
    return _vote(f.share(sum(map(eq, f.tokens, f.tokens[1:]))), 0.05, 0.15)


def few_words(f: Facts) -> int:
    """Texts of hardly any different tokens for their length."""
    if f.n < 30:
        return 0
    return _vote(1 - len(set(f.tokens)) / f.n**0.85, 0.5, 0.8)


def function_words(f: Facts) -> int:
    if f.n < 10:
        return 0
    words = f.raw.translate(WORD_BYTES).split()
    return _vote(1 - f.share(sum(map(FUNCTION_BYTES.__contains__, words))), 0.9, 0.98)


def bare_marks(f: Facts) -> int:
    return _vote(f.share(len(BARE.findall(f.raw))), 0.02, 0.1)


def length(f: Facts) -> int:
    return -1 if f.n < 1 else 0


def ends_of_sentences(f: Facts) -> int:
    if f.n < 20:
        return 0
    return _vote(1 - f.share(f.count(".!?")), 0.97, 0.995)


LABELLERS = [
    symbols, symbols_per_token, upper_case, exclamations, repeats_in_a_row, few_words, function_words, bare_marks,
    length, ends_of_sentences,
]


def votes(text: str | None, labellers=LABELLERS) -> str:
    """A sign for each labeller: + good, - bad, 0 nothing."""
    facts = Facts(text)
    return "".join("-0+"[labeller(facts) + 1] for labeller in labellers)


def fit_votes(patterns: dict[str, int], rounds: int = ROUNDS) -> tuple[dict[str, float], np.ndarray, float]:
    """Posterior of good per pattern; P(vote | class, a vote is given) as [labeller, class, vote]; prior of good.

    Classes and votes are bad, good; no vote says nothing. A labeller sees one kind of badness, so at first a bad vote is
    taken to be common among bad texts and rare among good ones (``FIRST_GUESS``); the rounds then find how often each
    is right. A count of one vote of each kind keeps all probabilities positive.
    """
    names = sorted(patterns)
    if not names:
        return {}, np.zeros((0, 2, 2)), 0.5
    n = np.array([patterns[p] for p in names], float)
    hot = np.array([[(c == "-", c == "+") for c in p] for p in names], float)  # pattern, labeller, vote
    told = np.tile(np.array(FIRST_GUESS), (hot.shape[1], 1, 1))
    prior = 0.8
    for _ in range(rounds):
        logs = np.einsum("plv,lcv->pc", hot, np.log(told)) + np.log([1 - prior, prior])
        post = np.exp(logs - logs.max(1, keepdims=True))
        post /= post.sum(1, keepdims=True)
        weight = post * n[:, None]
        told = np.einsum("pc,plv->lcv", weight, hot) + 1.0
        told /= told.sum(2, keepdims=True)
        prior = float(np.clip(weight[:, 1].sum() / n.sum(), 1e-3, 1 - 1e-3))
    return dict(zip(names, post[:, 1].tolist())), told, prior


#: Kinds of bytes: lower and upper case, digits, blanks, line feeds, long characters, and each mark by itself.
KIND = np.zeros(256, np.uint64)
for _b in range(256):
    _c = chr(_b)
    KIND[_b] = (
        1 if 97 <= _b <= 122 else 2 if 65 <= _b <= 90 else 3 if 48 <= _b <= 57 else 4 if _c == " " else 5 if _c == "\n"
        else 6 if _b >= 128 else 7 + _b % 25
    )
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text, scaled to unit length: square roots of the counts of its byte triples and of its runs of
    four kinds of bytes, and how varied the triples are; shrunk towards nothing for short texts."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    if len(raw) < 4:
        return np.zeros(0, np.int64), np.zeros(0)
    half, shift = buckets // 2, np.uint64(64 - (buckets // 2).bit_length() + 1)
    b, k = raw.astype(np.uint64), KIND[raw]
    triples = (b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16)) * SPREAD >> shift
    runs = (k[:-3] | k[1:-2] << np.uint64(5) | k[2:-1] << np.uint64(10) | k[3:] << np.uint64(15)) * SPREAD >> shift
    total = np.sqrt(np.bincount(np.concatenate((triples, runs + np.uint64(half))).astype(np.int64), minlength=buckets))
    places = np.flatnonzero(total)
    certain = len(raw) / (len(raw) + CERTAIN_BYTES)
    values = total[places] / np.sqrt((total**2).sum()) * certain
    different = np.count_nonzero(places < half) / min(len(triples), half) ** 0.8
    level = half + int(min(15, 8 * different)) * 16 + min(15, len(raw).bit_length())
    return np.append(places, level), np.append(values, 0.5 * certain)


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, buckets: int = BUCKETS, steps: int = 200):
    """Weights and bias of logistic regression on soft labels, by gradient descent with momentum."""
    weights, bias = np.zeros(buckets), 0.0
    if not rows:
        return weights, bias
    row = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    at, value = np.concatenate([p for p, _ in rows]).astype(np.int64), np.concatenate([v for _, v in rows])
    speed, drift = np.zeros(buckets), 0.0
    for _ in range(steps):
        z = np.bincount(row, weights[at] * value, len(rows)) + bias
        error = (target - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) / len(rows)
        speed = 0.9 * speed + 10.0 * (np.bincount(at, error[row] * value, buckets) - 1e-6 * weights)
        drift = 0.9 * drift + 2.0 * error.sum()
        weights, bias = weights + speed, bias + drift
    return weights, bias


SCORED = "doc_id bigint, votes string, posterior double, score double"


def pattern_counts(docs: DataFrame) -> dict[str, int]:
    """How many rows have each pattern of votes."""
    out_schema = "votes string, n bigint"
    schema = arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts.update(votes(text.as_py()) for text in batch.column(1))
        yield batches_of({"votes": list(counts), "n": list(counts.values())}, schema)

    counted = id_and_text(docs).mapInArrow(run, out_schema).groupBy("votes").agg(F.sum("n").alias("n"))
    return {r.votes: r.n for r in counted.collect()}


def sample_features(docs: DataFrame, rows: int, total: int) -> list:
    """``(votes, places, values)`` of about ``rows`` rows, twice that at most; a row that repeats counts once."""
    own = id_and_text(docs)
    if total > rows:
        chosen = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(7)), 1) < (rows << 63) // total
        own = own.filter(chosen).distinct()
    out_schema = "votes string, places array<int>, vals array<float>"
    schema = arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [features(t) for t in texts]
            columns = {"votes": [votes(t) for t in texts], "places": [p for p, _ in found], "vals": [v for _, v in found]}
            yield batches_of(columns, schema)

    return own.mapInArrow(run, out_schema).limit(2 * rows).collect()


def fit_quality(docs: DataFrame, train_rows: int = TRAIN_ROWS):
    """``(posteriors, weights, bias)`` of the corpus ``docs(doc_id, text)``."""
    counted = pattern_counts(docs)
    posteriors, _, _ = fit_votes(counted)
    sample = sample_features(docs, train_rows, sum(counted.values()))
    rows = [(np.array(r.places), np.array(r.vals)) for r in sample]
    target = np.array([posteriors[r.votes] for r in sample])
    return posteriors, *fit_scorer(rows, target)


def classify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, votes, posterior, score, keep)`` of every row of ``docs(doc_id, text)``; fits when called."""
    posteriors, weights, bias = fit_quality(docs, train_rows)
    schema = arrow_schema(SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            out["doc_id"] = batch.column(0).to_pylist()
            for value in batch.column(1):
                text = value.as_py()
                places, values = features(text)
                z = float(weights[places] @ values) + bias
                pattern = votes(text)
                out["votes"].append(pattern)
                out["posterior"].append(posteriors.get(pattern))
                out["score"].append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
            yield batches_of(out, schema)

    scored = id_and_text(docs).mapInArrow(run, SCORED)
    return scored.withColumn("keep", F.col("score") >= KEEP)


def keep_good(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    _, weights, bias = fit_quality(docs, train_rows)
    least = float(np.log(KEEP / (1 - KEEP)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = map(features, batch.column(batch.schema.names.index("text")).to_pylist())
            yield batch.filter(pa.array([float(weights[p] @ v) + bias >= least for p, v in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
