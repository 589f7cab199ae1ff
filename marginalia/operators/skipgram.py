"""Skip-gram word vectors whose parameters are a table keyed by word; no vocabulary is held by the driver or any one task.

Documents are cut into parts (``parts``). In an epoch every part gets the parameter rows of its words, adds up the gradients
of its pairs within a window by word and returns these sums; a few other words for each word, as counter-examples, meet it
by joins. The next epoch's parameters are a new table. Sums are of fixed-point integers, a term for each place of
a pair, so the vectors do not depend on how documents are dealt or in what order terms are added. Starts and counter-examples come from hashes, so a training repeats exactly
and can be written as SQL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.keys import hash_bucket
from marginalia.operators.parts import Dealt, deal, rows_of_words, unpack, with_parts
from marginalia.operators.staging import staged

#: Gradients are means, of the size of a vector's elements, and are summed in steps of 2**-44.
GRADIENT_BITS = 44
#: Document sums are multiples of 2**-32; an element may add up to 2**31.
DOCUMENT_BITS = 32
#: Parts of the vocabulary that are numbered apart.
NUMBER_BUCKETS = 4096
HASH_RANGE = 1 << 32
#: Tokens whose pairs a task looks at together.
CHUNK = 1 << 17


def window_pairs(documents: DataFrame, window_size: int = 5, text: str = "text") -> DataFrame:
    """``(word, context, n)``: how often two words stand at most ``window_size`` places apart, counted both ways.

    Null tokens keep their place and form no pair.
    """
    rows = documents.select(F.col(text).alias("t"), F.size(text).alias("size"))

    def apart(distance: int) -> Column:
        left = F.greatest(F.col("size") - distance, F.lit(0))
        return F.arrays_zip(
            F.slice("t", F.lit(1), left).alias("a"), F.slice("t", F.lit(1 + distance), left).alias("b")
        )

    pairs = rows.select(F.explode(F.array(*(apart(d) for d in range(1, window_size + 1)))).alias("p"))
    pairs = pairs.select(F.inline("p").alias("a", "b")).filter("a is not null and b is not null")
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    ways = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("context")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("context")),
    )
    both = counted.select(F.explode(ways).alias("w"), "n")
    return both.groupBy("w.word", "w.context").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with ``number`` from 0 and ``words``, how many there are; in order of bucket and word.

    Buckets are numbered apart and then moved by what stands before them, so no task orders the whole vocabulary.
    """
    parted = words.withColumn("bucket", hash_bucket(F.col("word"), NUMBER_BUCKETS))
    sizes = parted.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))  # at most NUMBER_BUCKETS rows
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"), F.sum("size").over(whole).alias("words")
    )
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("word")) - 1
    placed = parted.withColumn("place", place).join(F.broadcast(offsets), "bucket")
    return placed.withColumn("number", F.col("before") + F.col("place")).drop("bucket", "place", "before")


def _hashed(*parts: Column) -> Column:
    """32 bits from the MD5 of the parts, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")


def start(words: DataFrame, vector_size: int) -> DataFrame:
    """``(word, number, words, v_i, u_i)``: word vectors by hash, within half a unit over the size, context vectors zero."""
    own = [
        ((_hashed(F.col("word"), F.lit(str(i))) / F.lit(float(HASH_RANGE)) - 0.5) / vector_size).alias(f"v_{i}")
        for i in range(vector_size)
    ]
    return numbered(words).select("word", "number", "words", *own, *(F.lit(0.0).alias(f"u_{i}") for i in range(vector_size)))


def _drawn(epoch: int, draw: Column) -> Column:
    """The number of a word drawn by hash for the row's ``word``, each of the ``words`` with equal chance."""
    return F.pmod(_hashed(F.col("word"), F.lit(str(epoch)), draw.cast("string")), F.col("words"))


def counter_examples(parameters: DataFrame, epoch: int, negatives: int) -> DataFrame:
    """``(word, context)``: for every word ``negatives`` words drawn by hash, each word with equal chance."""
    draws = F.explode(F.sequence(F.lit(0), F.lit(negatives - 1))).alias("draw")
    drawn = parameters.select("word", "words", draws).select("word", _drawn(epoch, F.col("draw")).alias("number"))
    named = parameters.select("number", F.col("word").alias("context"))
    return drawn.join(named, "number").select("word", "context")


def _fixed(value: Column, bits: int) -> Column:
    return F.floor(value * float(1 << bits) + 0.5).cast("bigint")


def examples(pairs: DataFrame, parameters: DataFrame, epoch: int, negatives: int) -> DataFrame:
    """``(word, context, label, weight)``: the pairs, and as often as a word has pairs, each of its counter-examples."""
    positive = pairs.select("word", "context", F.lit(1.0).alias("label"), F.col("n").alias("weight"))
    if not negatives:
        return positive
    totals = pairs.groupBy("word").agg(F.sum("n").alias("weight"))
    negative = counter_examples(parameters, epoch, negatives).join(totals, "word")
    return positive.unionByName(negative.select("word", "context", F.lit(0.0).alias("label"), "weight"))


def next_parameters(parameters: DataFrame, given: DataFrame, vector_size: int, step: float) -> DataFrame:
    """The parameters after one step along the mean gradient of every word, from its examples ``given``.

    ``train`` makes the same step without a table of pairs.
    """
    size = range(vector_size)
    left = parameters.select("word", *(f"v_{i}" for i in size))
    right = parameters.select(F.col("word").alias("context"), *(f"u_{i}" for i in size))
    rows = given.join(left, "word").join(right, "context")
    score = sum((F.col(f"v_{i}") * F.col(f"u_{i}") for i in size[1:]), F.col("v_0") * F.col("u_0"))
    rows = rows.withColumn("error", (F.lit(1.0) / (1.0 + F.exp(-score)) - F.col("label")))
    new = parameters
    for key, own, other in (("word", "v", "u"), ("context", "u", "v")):
        weight = given.groupBy(key).agg(F.sum("weight").alias("total"))
        share = F.col("weight") / F.col("total") * F.col("error")
        sums = [F.sum(_fixed(share * F.col(f"{other}_{i}"), GRADIENT_BITS)).alias(f"g_{own}_{i}") for i in size]
        gradient = rows.join(weight, key).groupBy(key).agg(*sums)
        new = new.join(gradient.withColumnRenamed(key, "word"), "word", "left")
    moved = [
        (F.col(f"{x}_{i}") - step * (F.coalesce(f"g_{x}_{i}", F.lit(0)) / float(1 << GRADIENT_BITS))).alias(f"{x}_{i}")
        for x in "vu"
        for i in size
    ]
    return new.select("word", "number", "words", *moved)


def _near(tokens: np.ndarray, sizes: np.ndarray, window_size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of numbers, none negative, at most ``window_size`` places apart in one text, a chunk at a time."""
    ends = np.repeat(np.cumsum(sizes, dtype=np.int32), sizes)  # a part has fewer than 2 ** 31 tokens, or its row would not fit
    for distance in range(1, window_size + 1):
        for begin in range(0, len(tokens) - distance, CHUNK):
            to = min(begin + CHUNK, len(tokens) - distance)
            a, b = tokens[begin:to], tokens[begin + distance : to + distance]
            good = (a >= 0) & (b >= 0) & (np.arange(begin + distance, to + distance) < ends[begin:to])
            yield a[good], b[good]


def pair_totals(dealt: Dealt, places: DataFrame, window_size: int) -> DataFrame:
    """``(number, n)``: in how many pairs of known words each word stands."""

    def run(part: dict, rows: dict) -> dict:
        n = np.zeros(len(rows["at"]), np.int64)
        for a, b in _near(rows_of_words(part, rows), unpack(part["sizes"].as_py()), window_size):
            n += np.bincount(a, minlength=len(n)) + np.bincount(b, minlength=len(n))
        return {"number": rows["number"], "n": n}

    found = with_parts(dealt.parts, places, run, "number bigint, n bigint", "ids", "sizes")
    return found.groupBy("number").agg(F.sum("n").alias("n"))


def _columns(size: int) -> tuple[list[str], list[str]]:
    return [f"v_{i}" for i in range(size)], [f"u_{i}" for i in range(size)]


def pair_gradients(dealt: Dealt, places: DataFrame, weighed: DataFrame, window_size: int, vector_size: int) -> DataFrame:
    """``(number, g_v_i, g_u_i)``: sums over the pairs in each part, in fixed point."""
    vs, us = _columns(vector_size)
    one = float(1 << GRADIENT_BITS)

    def run(part: dict, rows: dict) -> dict:
        v, u = [rows[c] for c in vs], [rows[c] for c in us]
        share_v, share_u = (1.0 / np.maximum(rows[c], 1) for c in ("total_v", "total_u"))
        sums = {f"g_{c}": np.zeros(len(rows["at"]), np.int64) for c in vs + us}
        for a, b in _near(rows_of_words(part, rows), unpack(part["sizes"].as_py()), window_size):
            for word, context in ((a, b), (b, a)):
                left, right = [x[word] for x in v], [x[context] for x in u]
                score = left[0] * right[0]
                for x, y in zip(left[1:], right[1:]):
                    score = score + x * y
                error = 1.0 / (1.0 + np.exp(-score)) - 1.0
                for key, names, share, other in ((word, vs, share_v, right), (context, us, share_u, left)):
                    step = share[key] * error
                    for c, x in zip(names, other):
                        np.add.at(sums[f"g_{c}"], key, np.floor(step * x * one + 0.5).astype(np.int64))
        return {"number": rows["number"], **sums}

    schema = ", ".join(["number bigint", *(f"g_{c} bigint" for c in vs + us)])
    rows = places.join(weighed.select("number", "total_v", "total_u", *vs, *us), "number")
    return with_parts(dealt.parts, rows, run, schema, "ids", "sizes")


def counter_gradients(weighed: DataFrame, epoch: int, negatives: int, vector_size: int) -> DataFrame:
    """``(number, g_v_i, g_u_i)`` of the counter-examples, which weigh as much as their word has pairs."""
    vs, us = _columns(vector_size)
    draws = F.explode(F.sequence(F.lit(0), F.lit(negatives - 1))).alias("draw")
    drawn = weighed.filter("n > 0").select("number", "word", "words", "n", "total_v", *vs, draws)
    drawn = drawn.select("number", "n", "total_v", *vs, _drawn(epoch, F.col("draw")).alias("context"))
    rows = drawn.join(weighed.select(F.col("number").alias("context"), "total_u", *us), "context")
    score = sum((F.col(v) * F.col(u) for v, u in zip(vs[1:], us[1:])), F.col("v_0") * F.col("u_0"))
    rows = rows.withColumn("error", F.lit(1.0) / (1.0 + F.exp(-score)))
    sides = []
    for key, total, own, other in (("number", "total_v", vs, us), ("context", "total_u", us, vs)):
        step = F.col("n") / F.col(total) * F.col("error")
        terms = {c: _fixed(step * F.col(x), GRADIENT_BITS) for c, x in zip(own, other)}
        none = F.lit(0).cast("bigint")
        sides.append(F.struct(F.col(key).alias("number"), *(terms.get(c, none).alias(f"g_{c}") for c in vs + us)))
    return rows.select(F.inline(F.array(*sides)))


def epoch_step(
    dealt: Dealt, places: DataFrame, parameters: DataFrame, epoch: int, negatives: int, window_size: int, vector_size: int, step: float
) -> DataFrame:
    """``parameters``, with ``n`` pairs of each word, after one step along the mean gradient of every word."""
    vs, us = _columns(vector_size)
    weights = parameters.select("number", F.lit(0).cast("bigint").alias("drawn")).limit(0)
    if negatives:
        draws = F.explode(F.sequence(F.lit(0), F.lit(negatives - 1))).alias("draw")
        drawn = parameters.filter("n > 0").select("word", "words", "n", draws).select(_drawn(epoch, F.col("draw")).alias("number"), "n")
        weights = drawn.groupBy("number").agg(F.sum("n").alias("drawn"))
    total_u = F.col("n") + F.coalesce("drawn", F.lit(0))
    weighed = parameters.join(weights, "number", "left").withColumns({"total_v": F.col("n") * (1 + negatives), "total_u": total_u})
    weighed = staged(weighed.drop("drawn"))
    terms = pair_gradients(dealt, places, weighed, window_size, vector_size)
    if negatives:
        terms = terms.unionByName(counter_gradients(weighed, epoch, negatives, vector_size))
    sums = terms.groupBy("number").agg(*(F.sum(f"g_{c}").alias(f"g_{c}") for c in vs + us))
    moved = [(F.col(c) - step * (F.coalesce(f"g_{c}", F.lit(0)) / float(1 << GRADIENT_BITS))).alias(c) for c in vs + us]
    return weighed.join(sums, "number", "left").select("word", "number", "words", "n", *moved)


def train(
    documents: DataFrame,
    vector_size: int = 3,
    min_count: int = 0,
    window_size: int = 5,
    epochs: int = 2,
    negatives: int = 5,
    step: float = 1.0,
    text: str = "text",
    dealt: Dealt | None = None,
) -> DataFrame:
    """``(word, number, words, v_i, u_i)`` after ``epochs`` steps, for words that occur at least ``min_count`` times.

    Rarer words keep their place in the window. Each epoch's parameters are written before the next reads them.
    ``dealt`` are the documents dealt before, with the same ``min_count``.
    """
    dealt = dealt or deal(documents, min_count, text)
    parameters = staged(start(dealt.known.select("word").distinct(), vector_size))
    if epochs:
        places = staged(dealt.known.join(parameters.select("word", "number"), "word").select("part", "at", "number"))
        pairs = pair_totals(dealt, places, window_size)
        parameters = staged(parameters.join(pairs, "number", "left").fillna(0, ["n"]))
    for epoch in range(epochs):
        parameters = staged(epoch_step(dealt, places, parameters, epoch, negatives, window_size, vector_size, step))
    return parameters.select("word", "number", "words", *(c for names in _columns(vector_size) for c in names))


def mean_loss(pairs: DataFrame, parameters: DataFrame, vector_size: int) -> DataFrame:
    """``(loss)``: the mean logistic loss of ``pairs(word, context, label, weight)``."""
    size = range(vector_size)
    rows = pairs.join(parameters.select("word", *(f"v_{i}" for i in size)), "word")
    rows = rows.join(parameters.select(F.col("word").alias("context"), *(f"u_{i}" for i in size)), "context")
    score = sum(F.col(f"v_{i}") * F.col(f"u_{i}") for i in size)
    loss = F.log1p(F.exp(F.when(F.col("label") == 1.0, -score).otherwise(score)))
    return rows.agg((F.sum(loss * F.col("weight")) / F.sum("weight")).alias("loss"))


def text_sums(dealt: Dealt, parameters: DataFrame, vector_size: int) -> DataFrame:
    """``(k, tokens, s_i)`` of every row: its key, how many tokens it has, and its known words' vectors added up in fixed point."""
    vs, _ = _columns(vector_size)
    kind = dealt.parts.schema["keys"].dataType.elementType.simpleString()
    one = float(1 << DOCUMENT_BITS)

    def run(part: dict, rows: dict) -> dict:
        sizes = unpack(part["sizes"].as_py())
        ends = np.cumsum(sizes, dtype=np.int64)
        row = rows_of_words(part, rows)

        def by_text(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
            return upto[ends] - upto[ends - sizes]

        fixed = [np.append(np.floor(rows[c] * one + 0.5).astype(np.int64), 0) for c in vs]  # -1 reads the last
        sums = {f"s_{i}": by_text(values[row]) for i, values in enumerate(fixed)}
        return {"k": part["keys"].values, "tokens": by_text(unpack(part["ids"].as_py()) >= 0), **sums}

    vectors = dealt.known.select("part", "at", "word").join(parameters.select("word", *vs), "word").drop("word")
    schema = ", ".join([f"k {kind}", "tokens bigint", *(f"s_{i} bigint" for i in range(vector_size))])
    return with_parts(dealt.parts, vectors, run, schema, "ids", "sizes", "keys")


def text_means(vector_size: int) -> list[Column]:
    """From ``text_sums``: the sum of the known words' vectors over the number of all tokens; zero without tokens."""
    one = float(1 << DOCUMENT_BITS)
    return [F.coalesce(F.try_divide(F.col(f"s_{i}") / one, F.col("tokens")), F.lit(0.0)) for i in range(vector_size)]


def document_vectors(
    documents: DataFrame, parameters: DataFrame, key: str, vector_size: int, text: str = "text", dealt: Dealt | None = None
) -> DataFrame:
    """``(key, r_i)``: the sum of the known words' vectors over the number of all tokens; zero without tokens.

    Rows with one key are one document; a null key is a key. ``dealt`` are the documents dealt before, with that key.
    """
    found = text_sums(dealt or deal(documents, 0, text, key), parameters, vector_size)
    totals = found.groupBy("k").agg(F.sum("tokens").alias("tokens"), *(F.sum(f"s_{i}").alias(f"s_{i}") for i in range(vector_size)))
    return totals.select(F.col("k").alias(key), *(m.alias(f"r_{i}") for i, m in enumerate(text_means(vector_size))))
