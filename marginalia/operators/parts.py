"""Documents cut into parts of bounded size, each with a dictionary of its own words.

What words carry (numbers, vectors) reaches a part as one row for each of its different words, and what a part adds up
goes back the same way. So neither a row for each token or pair is shuffled, nor does a task hold the whole vocabulary.
Parts are dealt into buckets when they are written; a pass over them shuffles only the rows of their words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from marginalia.operators.staging import bucketed, buckets, staged

#: A part is closed once it has this many tokens.
TOKENS_PER_PART = 4_000_000
#: Rows that reach Python together, whose tokens are held as text.
ROWS_PER_BATCH = 500


def pack(values: np.ndarray) -> bytes:
    """32-bit numbers, byte by byte of their size, compressed."""
    planes = np.ascontiguousarray(values, np.int32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.int32).ravel()


class _Part:
    """Tokens read so far, each batch by its own dictionary."""

    def __init__(self) -> None:
        self.texts: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.keys: list[pa.Array] = []
        self.tokens = 0

    def add(self, texts: pa.Array, keys: pa.Array | None) -> None:
        self.texts.append(texts.flatten().dictionary_encode())
        self.sizes.append(pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int32))
        self.tokens += len(self.texts[-1])
        if keys is not None:
            self.keys.append(keys)

    def row(self, number: int) -> dict[str, list | pa.Array]:
        """Words in order of their number here, so that frequent ones have small numbers."""
        coded = pa.chunked_array(self.texts).unify_dictionaries()
        self.texts.clear()
        words = coded.chunk(0).dictionary
        ids = np.concatenate([pc.fill_null(c.indices, len(words)).to_numpy(zero_copy_only=False) for c in coded.chunks])
        counts = np.bincount(ids, minlength=len(words) + 1)[:-1]  # nulls come last
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(words) + 1, np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        rank[-1] = -1
        row = {"part": [number], "words": _list(words.take(pa.array(order))), "counts": _list(pa.array(counts[order], pa.int64()))}
        row |= {"ids": [pack(rank[ids])], "sizes": [pack(np.concatenate(self.sizes))]}
        if self.keys:
            row["keys"] = _list(pa.concat_arrays(self.keys))
        return row


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def in_parts(documents: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """``(part, words, counts, ids, sizes)`` and ``keys`` of all rows: tokens by their word's place in ``words``
    (-1: null) and how many each row has, packed."""
    columns = [F.col(text).alias("t")] + ([F.col(key).alias("k")] if key else [])
    rows = documents.select(*columns)
    cores = documents.sparkSession.sparkContext.defaultParallelism
    schema = "part bigint, words array<string>, counts array<bigint>, ids binary, sizes binary"
    if key:
        schema += f", keys array<{rows.schema['k'].dataType.simpleString()}>"
    limit = TOKENS_PER_PART

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, part, done = TaskContext.get().partitionId() << 32, _Part(), 0
        for batch in batches:
            part.add(batch.column(0), batch.column(1) if key else None)
            if part.tokens >= limit:
                yield pa.RecordBatch.from_pydict(part.row(first + done))
                part, done = _Part(), done + 1
        if part.sizes:
            yield pa.RecordBatch.from_pydict(part.row(first + done))

    # Fewer and larger parts have fewer words in all; a task writes as many as it needs.
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = documents.sparkSession.conf
    before = conf.get(name)
    conf.set(name, min(ROWS_PER_BATCH, int(before)) if int(before) > 0 else ROWS_PER_BATCH)
    try:  # the conf counts while the table is written
        return bucketed(rows.coalesce(cores).mapInArrow(run, schema), "part")
    finally:
        conf.set(name, before)


def counted(parts: DataFrame, min_count: int) -> DataFrame:
    """``(part, at, word, n)``: the words of each part that occur at least ``min_count`` times in all, and how often."""
    listed = parts.select("part", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    listed = listed.select("part", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("word"))  # a word has a row for each part at most
    return staged(listed.withColumn("n", whole).filter(F.col("n") >= min_count))


@dataclass(frozen=True)
class Dealt:
    """Documents in parts, and the ``(part, at, word, n)`` of their words that are common enough."""

    parts: DataFrame
    known: DataFrame
    key: str | None = None


def deal(documents: DataFrame, min_count: int = 0, text: str = "text", key: str | None = None) -> Dealt:
    parts = in_parts(documents, text, key)
    return Dealt(parts, counted(parts, min_count), key)


def with_parts(parts: DataFrame, rows: DataFrame, run: Callable[[dict, dict], dict], schema: str, *columns: str) -> DataFrame:
    """``schema`` from ``run``, which gets the ``columns`` of each part and the arrays of its ``rows``; parts without rows too.

    Rows of no part are not looked at.
    """
    columns = ("part", *columns)
    fields = arrow_schema(schema)

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return fields.empty_table()
        own = {c: left.column(c)[0] for c in columns}
        found = run(own, {c: right.column(c).to_numpy() for c in right.column_names})
        return pa.Table.from_pydict(found, schema=fields)

    # By number, so that small rows do not put several parts into one task.
    dealt = rows.repartition(buckets(rows.sparkSession), "part")
    return parts.select(*columns).groupBy("part").cogroup(dealt.groupBy("part")).applyInArrow(joined, schema)


def arrow_schema(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def rows_of_words(part: dict, rows: dict, ids: str = "ids") -> np.ndarray:
    """By token, the number of its word's row, -1 where it has none."""
    tokens = unpack(part[ids].as_py())
    row = np.full(max(tokens.max(initial=-1), rows["at"].max(initial=-1)) + 2, -1, np.int32)
    row[rows["at"]] = np.arange(len(rows["at"]), dtype=np.int32)
    return row[tokens]  # null tokens read the last place
