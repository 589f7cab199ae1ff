"""Best-fit decreasing packing of token sequences, over all documents at once.

A document is its token ids and an end token; only documents longer than a sequence are cut. Best-fit decreasing
sees nothing of a piece but its length, and there are no more lengths than a sequence has tokens. So the pieces are counted by
length, and the packing runs on those counts: pieces of one length fill open bins from the tightest upwards, and a
segment tree over the remaining capacities finds the tightest class of bins that still fits. Bins with equal room
are held as ranges of bin numbers, and one step places all pieces of one length that go to one range. The result
is that of packing piece by piece over the whole table.

A step leaves each bin of its range less room than the length placed, and so less than half of what it had; each length adds
at most three ranges. There are therefore at most ``3 * size * log2(size)`` steps whatever the number of
documents, which bounds what is sent to the tasks. Every piece finds its step by its rank among
the pieces of its length: its rank within the task that made it, plus the pieces of that length in earlier tasks.

Null text counts as empty and gives the end token alone. Texts of any length are processed whole. Null ids are handed on, rows
that repeat are packed each, an empty table gives an empty one; only id and text are read. A special token's string inside a text is read as
that token, as the tokenizer does by default.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import arrow_schema, batches_of, id_and_text
from marginalia.llm.merges import DIGITS, LOWER_LETTERS, PLAIN, Words
from marginalia.operators.staging import staged

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SIZE = 2048
#: The token that ends each document.
END = 0
#: Chunks a task remembers before it starts anew.
REMEMBERED = 1 << 19
#: Texts that are encoded together.
TOGETHER = 200


#: The tokenizer's own pattern on lower-cased plain chunks, where its classes come down to these ranges.
WORDS = re.compile(rf"[{LOWER_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{DIGITS}]|[^\s{LOWER_LETTERS}{DIGITS}]+").findall


class Chunks(dict):
    """Ids, as bytes, of what stands between ASCII white space: by words where it is plain text, else by the tokenizer."""

    def __init__(self, tokenizer, code: str):
        self.words, self.tokenizer, self.code = Words(tokenizer, code), tokenizer, code
        special = [re.escape(token.content) for token in tokenizer.get_added_tokens_decoder().values()]
        self.plain = re.compile("".join(f"(?!.*{token})" for token in special) + f"[{PLAIN}]*").fullmatch

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if self.plain(text):
            ids = b"".join(map(self.words.__getitem__, WORDS(text.lower())))
        else:
            ids = array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[chunk] = ids
        return ids


class ChunkEncoder:
    """Token ids of texts by a tokenizer that lower-cases and drops white space: each distinct chunk is encoded once.

    Neither the normalisation nor the words of such a tokenizer reach over white space, so the ids of a text are those of its
    chunks in order.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.known = Chunks(tokenizer, "H" if tokenizer.get_vocab_size() <= 1 << 16 else "I")

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.known.words.clear()
        ids_of, code = self.known.__getitem__, self.known.code
        return [np.frombuffer(b"".join(map(ids_of, (text or "").encode().split())), code) for text in texts]


def pieces(docs: DataFrame, path: str = TOKENIZER, size: int = SIZE, end: int = END, with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, [ids,] task, place)``: documents cut at every ``size`` tokens.

    ``place`` counts the pieces of that length which the same task made before.
    """
    ddl = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    ddl += "ids array<int>, " * with_ids + "task int, place bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, task = ChunkEncoder(path), [0] * (size + 1), TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                out: dict[str, list] = {field.name: [] for field in schema}
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                    whole = np.append(ids.astype("<u4"), np.uint32(end))
                    for piece, start in enumerate(range(0, len(whole), size)):
                        own = whole[start : start + size]
                        out["doc_id"].append(doc_id)
                        out["piece"].append(piece)
                        out["start"].append(start)
                        out["length"].append(len(own))
                        out["ids_crc32"].append(zlib.crc32(own.tobytes()))
                        out["task"].append(task)
                        out["place"].append(seen[len(own)])
                        if with_ids:
                            out["ids"].append(own.tolist())
                        seen[len(own)] += 1
                yield batches_of(out, schema)

    return id_and_text(docs).mapInArrow(run, ddl)


class OpenBins:
    """Ranges of open bins by remaining capacity, over a segment tree that tells which capacities are there."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.held = [0] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def _count(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.held[node] += change
            node >>= 1

    def put(self, room: int, first: int, after: int) -> None:
        """Bins ``first`` to ``after`` (exclusive) have ``room`` left; full ones are closed."""
        if room and first < after:
            self.ranges[room].append((first, after))
            self._count(room, 1)

    def tightest(self, length: int) -> int | None:
        """The smallest room of any open bin that holds ``length``."""
        node = self.leaves + length
        while not self.held[node]:
            while node & 1:  # a right child: go on above
                node >>= 1
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.held[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, room: int) -> tuple[int, int]:
        self._count(room, -1)
        return self.ranges[room].pop()


def best_fit_steps(counts: dict[int, int], size: int = SIZE) -> np.ndarray:
    """Steps ``(length, first rank, first bin, pieces a bin, offset)`` that pack ``counts`` pieces by length, longest first.

    A step holds for the ranks of its length up to the next step's.
    """
    bins, steps, opened = OpenBins(size), [], 0
    for length in sorted(counts, reverse=True):
        rank, count = 0, counts[length]
        while rank < count:
            room = bins.tightest(length)
            if room is None:
                room = size
                first, after = opened, opened - (rank - count) // (size // length)
                opened = after
            else:
                first, after = bins.take(room)
            each = room // length
            steps.append((length, rank, first, each, size - room))
            full = min(after - first, (count - rank) // each)
            bins.put(room - each * length, first, first + full)
            rank, first = rank + full * each, first + full
            if rank < count and first < after:  # one bin takes fewer
                bins.put(room - (count - rank) * length, first, first + 1)
                rank, first = count, first + 1
            bins.put(room, first, after)
    return np.array(sorted(steps), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str = TOKENIZER, size: int = SIZE, end: int = END, with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset)``: every piece and its place in a sequence.

    Sequences hold at most ``size`` tokens, filled from 0 without gaps; they are numbered from 0.
    """
    cut = staged(pieces(docs, path, size, end, with_ids))
    made = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    made = staged(made.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    counts = {r.length: r.n for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a length
    steps = best_fit_steps(counts, size)
    ranked = cut.join(made.drop("n"), ["length", "task"]).withColumn("rank", F.col("before") + F.col("place"))
    kept = [c for c in cut.columns if c not in ("task", "place")]
    ranked = ranked.select(*kept, "rank")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.drop("rank").schema)
    ddl += ", sequence_id bigint, offset bigint"
    schema = arrow_schema(ddl)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A rank beyond the largest first rank belongs to the last step of its length, as that rank does.
        largest = int(steps[:, 1].max(initial=0))
        keys = steps[:, 0] * (largest + 1) + steps[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            step = np.searchsorted(keys, length * (largest + 1) + np.minimum(rank, largest), side="right") - 1
            _, first, bin_, each, offset = steps[step].T
            bins, within = np.divmod(rank - first, each)
            columns = [batch.column(c) for c in kept] + [pa.array(bin_ + bins), pa.array(offset + within * length)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return ranked.mapInArrow(place, ddl)
