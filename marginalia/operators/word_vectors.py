"""Word vectors and document vectors (``text array<string>``)."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators import skipgram, word_tree
from marginalia.operators.parts import Dealt, deal
from marginalia.operators.staging import staged
from marginalia.operators.word_tree import WordTable

# Spark ML holds word vectors whole on the driver and on every executor while training.
MODEL_BYTES = 2 << 30
#: Words up to which Spark ML trains, at about a kilobyte a word on the driver; more are trained as a table.
DRIVER_WORDS = 250_000
TOKENS_PER_PARTITION = 500_000


def vocabulary(documents: DataFrame, min_count: int = 0, text: str = "text") -> DataFrame:
    """``(word, n)``: every word that occurs at least ``min_count`` times."""
    words = documents.select(F.explode_outer(text).alias("word")).filter("word is not null")
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def fit_word_vectors(
    documents: DataFrame,
    vector_size: int = 3,
    min_count: int = 0,
    seed: int = 1,
    num_partitions: int | None = None,
    max_iter: int = 1,
    window_size: int = 5,
    text: str = "text",
    dealt: Dealt | None = None,
) -> Word2VecModel | WordTable:
    """Skip-gram word vectors.

    The vocabulary is counted first. More than ``DRIVER_WORDS`` words are trained as a table (``word_tree``), by the same
    method with one part of the documents a task, and other random numbers. Else the tokens set the number of partitions
    that train side by side (one per ``TOKENS_PER_PARTITION`` tokens, up to the cores there are; one partition repeats
    exactly for a seed), and a model too large to hold is refused instead of cut down. ``dealt`` are the documents dealt
    before, with the same ``min_count``.
    """
    dealt = dealt or deal(documents, min_count, text)
    counts = staged(dealt.known.groupBy("word").agg(F.first("n").alias("n")))
    words, tokens = counts.agg(F.count("*"), F.sum("n")).first()
    if words > DRIVER_WORDS:
        return word_tree.fit(dealt, counts, vector_size, window_size, max_iter, seed)
    held = documents.select(text).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if 8 * words * vector_size > MODEL_BYTES:
            raise ValueError(
                f"{words} words of {vector_size} numbers exceed {MODEL_BYTES} bytes; raise min_count"
            )
        cores = documents.sparkSession.sparkContext.defaultParallelism
        partitions = num_partitions or max(1, min(cores, math.ceil((tokens or 0) / TOKENS_PER_PARTITION)))
        estimator = Word2Vec(
            vectorSize=vector_size,
            minCount=min_count,
            seed=seed,
            numPartitions=partitions,
            maxIter=max_iter,
            windowSize=window_size,
            inputCol=text,
            outputCol="result",
        )
        return estimator.fit(held)
    finally:
        held.unpersist()


def document_vectors(
    model: Word2VecModel | WordTable, documents: DataFrame, text: str = "text", dealt: Dealt | None = None
) -> DataFrame:
    """Add ``result array<double>``: the sum of the known words' vectors over the number of all tokens.

    A table of words takes tokens from the column ``text``, a Spark ML model from its own input column. ``dealt`` are the
    documents dealt before, with a key; with a table of words the rows are then ``(key, result)``.
    """
    if not isinstance(model, WordTable):
        return model.transform(documents).withColumn("result", vector_to_array("result"))
    result = F.array(*skipgram.text_means(model.vector_size)).alias("result")
    if dealt:
        return skipgram.text_sums(dealt, model.vectors, model.vector_size).select(F.col("k").alias(dealt.key), result)
    rows = staged(documents.withColumn("row_id", F.monotonically_increasing_id()))
    found = skipgram.text_sums(deal(rows, 0, text, "row_id"), model.vectors, model.vector_size)
    return rows.join(found.select(F.col("k").alias("row_id"), result), "row_id").drop("row_id")


def word_vectors(model: Word2VecModel | WordTable) -> DataFrame:
    """``(word, vector array<double>)``."""
    if isinstance(model, WordTable):
        return model.vectors.select("word", F.array(*(f"v_{i}" for i in range(model.vector_size))).alias("vector"))
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))
