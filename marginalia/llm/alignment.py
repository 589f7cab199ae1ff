"""Which tokens of two tokenizers cover the same bytes, and how often every pair of ids does so in the corpus.

A text, with a space before it, is tokenised both ways. Byte offsets where both have a token's end cut it into groups;
two tokens are linked where their byte ranges overlap, which is one link for each stretch between neighbouring ends of either side.

Both tokenizers begin anew at a space between two other characters, the second no white space: the pattern of the first ends
a pre-token there, and no piece of the second has a space after another character. So texts are cut there, and each distinct
chunk is tokenised and aligned once.

Counting is external. Every task writes the links of a block of documents as records ``(pair, document, occurrences)``,
radix-partitioned by the first side's id and sorted into runs packed with zstd. A run's pairs and their documents, one number a pair, go to
the task of their radix, where a k-way heap merge adds them up; the order is by the first id, so the ids' highest counts come
out with it. The totals then stream past the same runs and answer each, and the answers meet the records of their block, which
add up per document. A pair that is in every document thus is one entry a block, in whatever radix.

Texts that are null or empty have no tokens, nor have those whose tokens of either side do not spell the text with its space. Texts of
any length are processed whole, in a block of their own if need be. Null ids are handed on, rows that repeat are
documents of their own and count each, an empty table gives an empty one; only id and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from itertools import chain, compress, groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.byte_bpe import byte_characters
from marginalia.llm.common import arrow_schema, id_and_text
from marginalia.llm.merges import DIGITS, LETTERS, PLAIN, Words
from marginalia.operators.staging import staged

TOKENIZER_A = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_B = public_tokenizers.path("piece_bpe_32k.model")
#: Both sides end a token before such a space.
CUT = re.compile(r" (?<=[^ ] )(?=\S)").split
#: The first tokenizer's own pattern on plain text, where its classes come down to these ranges.
WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\s{LETTERS}{DIGITS}]+"
).findall
IS_PLAIN = re.compile(f"[{PLAIN}]+").fullmatch
#: Parts by the first id's low bits; the tasks that count can be no more than these.
RADIXES = 256
#: Records of a block, beyond which the next document starts a new one; documents have 24 bits.
BLOCK_RECORDS, BLOCK_DOCUMENTS = 4_000_000, 1 << 20
#: Chunks after which a task ends its block and starts anew.
REMEMBERED = 1 << 19
#: Texts that are encoded together.
TOGETHER = 200
#: Runs merged at once.
FAN_IN = 256

HEAD = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
BLOCKS = "block bigint, radix int, pairs binary, held binary, records binary, answer binary, " + ", ".join(
    f"{c} array<{'string' if c == 'groups_sha256' else 'bigint'}>" for c in HEAD
)


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays as one zstd frame, each in the fewest bytes that hold its values, byte by byte."""
    parts = []
    for values in arrays:
        width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
        planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
        parts += [np.array([len(values), width], "<u8").tobytes(), planes.tobytes()]
    return zstandard.compress(b"".join(parts), 1)


def unpack(frame: bytes) -> list[np.ndarray]:
    """The arrays of ``pack``, as 64-bit integers."""
    data, at, out = zstandard.decompress(frame), 0, []
    while at < len(data):
        n, width = np.frombuffer(data, "<u8", 2, at).tolist()
        planes = np.frombuffer(data, np.uint8, n * width, at + 16).reshape(width, n)
        values = np.zeros((n, 8), np.uint8)
        values[:, :width] = planes.T
        out.append(values.view("<i8").ravel())
        at += 16 + n * width
    return out


def deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=0)


def flat_a(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and how many each has."""
    return np.frombuffer(b"".join(ids), np.uint16).astype(np.int64), np.array(list(map(len, ids))) // 2


def flat_b(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array(list(map(len, ids)))
    return np.fromiter(chain.from_iterable(ids), np.int64, n.sum()), n


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are ordinary text
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        entries = {i: t for t, i in self.a.get_vocab().items()}
        self.bytes_a = [
            b"".join(byte_of.get(c, c.encode()) for c in entries.get(i, "")) for i in range(max(entries) + 1)
        ]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << 16:
            raise ValueError("a vocabulary has more than 65536 ids")
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        if not all(re.fullmatch("▁*[^▁]*", p) for p in pieces):
            raise ValueError("a piece reaches over a space")
        self.words = Words(self.a, "H")
        self.size_a, self.size_b = (np.array([len(t) for t in side]) for side in (self.bytes_a, self.bytes_b))
        digits = np.array([str(i) for i in range(1 << 16)], "S6")
        self.digits, self.written = digits.view(np.uint8).reshape(-1, 6), np.strings.str_len(digits)

    def tokens(self, chunks: list[str]) -> tuple[list[bytes], list[list[int]], np.ndarray]:
        """Ids of either side of each chunk, the first's as 16-bit numbers, and whether both spell it with a space before it."""
        spaced = [" " + chunk for chunk in chunks]
        plain = [IS_PLAIN(chunk) is not None for chunk in chunks]
        other = [text for text, is_plain in zip(spaced, plain) if not is_plain]
        whole, ids_of = iter(self.a.encode_batch(other, add_special_tokens=False)), self.words.__getitem__
        a = [
            b"".join(map(ids_of, WORDS(text))) if is_plain else np.array(next(whole).ids, np.uint16).tobytes()
            for text, is_plain in zip(spaced, plain)
        ]
        b = self.b.encode(chunks, num_threads=1)
        texts = [text.encode() for text in spaced]
        good, ends = np.ones(len(chunks), bool), np.cumsum(list(map(len, texts)))
        for ids, n, token, sizes in (
            (*flat_a(a), self.bytes_a, self.size_a),
            (*flat_b(b), self.bytes_b, self.size_b),
        ):
            until = np.concatenate([[0], np.cumsum(sizes[ids])])[np.cumsum(n)]
            # Where the lengths agree everywhere and so do all bytes in a row, every chunk is spelt.
            spelt = list(map(token.__getitem__, ids.tolist()))
            if (until != ends).any() or b"".join(spelt) != b"".join(texts):
                bounds = [0, *np.cumsum(n).tolist()]
                good &= [b"".join(spelt[i:j]) == text for i, j, text in zip(bounds, bounds[1:], texts)]
        return a, b, good

    def written_groups(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple:
        """All groups as text, each ended by a semicolon, and where each ends."""
        groups = int(group_a[-1]) + 1
        until_a, until_b = (np.cumsum(np.bincount(g, minlength=groups)) for g in (group_a, group_b))
        place_a = np.arange(len(a)) + np.concatenate([[0], until_b])[group_a]
        place_b = np.arange(len(b)) + until_a[group_b]
        ids, after = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        ends = until_a + until_b
        after[until_a + np.concatenate([[0], until_b[:-1]]) - 1] = ord("|")
        after[ends - 1] = ord(";")
        length = self.written[ids]
        text = self.digits[ids]
        text[np.arange(len(ids)), length] = after
        return text[np.arange(6) <= length[:, None]].tobytes(), np.cumsum(length + 1)[ends - 1]


class Chunks:
    """Numbers of the distinct chunks met, and their alignments."""

    def __init__(self, vocabularies: Vocabularies):
        self.vocabularies, self.number, self.texts = vocabularies, {}, []
        self.totals = np.zeros((0, 4), np.int64)  # tokens of either side, groups, links; all zero where not spelt
        self.pairs: list[np.ndarray] = []

    def learn(self, chunks: list[str]) -> None:
        v = self.vocabularies
        sides_a, sides_b, good = v.tokens(chunks)
        totals, texts = np.zeros((len(chunks), 4), np.int64), iter(())
        if good.any():
            a, n_a = flat_a(list(compress(sides_a, good)))
            b, n_b = flat_b(list(compress(sides_b, good)))
            end_a, end_b = np.cumsum(v.size_a[a]), np.cumsum(v.size_b[b])  # chunks one after the other
            ended = np.zeros(end_a[-1] + 1, np.uint8)
            ended[end_a] = 1
            ended[end_b] += 1
            ends, group_ends = np.flatnonzero(ended), np.flatnonzero(ended == 2)
            link_a, link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
            text, text_ends = v.written_groups(a, b, np.searchsorted(group_ends, end_a), np.searchsorted(group_ends, end_b))
            chunk_ends = end_a[np.cumsum(n_a) - 1]
            n_groups = np.diff(np.searchsorted(group_ends, chunk_ends, side="right"), prepend=0)
            n_links = np.diff(np.searchsorted(ends, chunk_ends, side="right"), prepend=0)
            totals[good] = np.stack([n_a, n_b, n_groups, n_links], axis=1)
            self.pairs.append((a[link_a] << 16 | b[link_b]).astype(np.uint32))
            cuts = [0, *text_ends[np.cumsum(n_groups) - 1].tolist()]
            texts = (text[i:j] for i, j in zip(cuts, cuts[1:]))
        self.texts += [next(texts) if ok else None for ok in good.tolist()]
        self.number.update(zip(chunks, range(len(self.number), len(self.texts))))
        self.totals = np.concatenate([self.totals, totals])


class Block:
    """Aligned documents of one task."""

    def __init__(self, number: int):
        self.number, self.records = number, 0
        self.head: dict[str, list] = {c: [] for c in HEAD}
        self.chunks, self.counts = [], []

    def add(self, doc_id: int | None, cut: list[str], known: Chunks) -> None:
        chunks = np.fromiter(map(known.number.__getitem__, cut), np.int64, len(cut))
        totals = known.totals[chunks]
        texts = [known.texts[k] for k in chunks.tolist()] if totals.all() else []
        sums = totals.sum(axis=0).tolist() if texts else [0] * 4
        digest = hashlib.sha256(b"".join(texts)[:-1]).hexdigest() if texts else ""
        for c, value in zip(HEAD, [doc_id, *sums, digest]):
            self.head[c].append(value)
        chunks, counts = np.unique(chunks if texts else chunks[:0], return_counts=True)
        self.chunks.append(chunks)
        self.counts.append(counts)
        self.records += int(known.totals[chunks, 3].sum())

    def full(self) -> bool:
        return self.records >= BLOCK_RECORDS or len(self.chunks) == BLOCK_DOCUMENTS

    def rows(self, known: Chunks, radixes: int) -> Iterator[dict]:
        """A row with the documents, then a run for each radix: sorted pairs, documents of each, records."""
        yield {"block": self.number, **self.head}
        if not self.records:
            return
        chunk, count = np.concatenate(self.chunks), np.concatenate(self.counts)
        doc = np.repeat(np.arange(len(self.chunks)), [len(c) for c in self.chunks])
        links, pairs = known.totals[:, 3], np.concatenate(known.pairs)
        start, n = (np.cumsum(links) - links)[chunk], links[chunk]
        at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
        pair = pairs[at].astype(np.uint64)
        radix = (pair >> np.uint64(16)) % np.uint64(radixes)
        key = radix << np.uint64(56) | pair << np.uint64(24) | np.repeat(doc, n).astype(np.uint64)
        count = np.repeat(count, n)
        order = np.argsort(key)
        key = key[order]
        starts = np.flatnonzero(np.diff(key, prepend=key[0] + np.uint64(1)))
        key, count = key[starts], np.add.reduceat(count[order], starts)
        bounds = np.searchsorted(key, np.arange(radixes + 1, dtype=np.uint64) << np.uint64(56)).tolist()
        if radixes == 256:
            bounds[-1] = len(key)  # the last bound has no 64 bits
        for part, (i, j) in enumerate(zip(bounds, bounds[1:])):
            if i < j:
                own = (key[i:j] >> np.uint64(24)).astype(np.int64) & 0xFFFFFFFF
                docs = (key[i:j] & np.uint64(0xFFFFFF)).astype(np.int64)
                first = np.flatnonzero(np.diff(own, prepend=-1))
                held = np.diff(first, append=len(own))
                step = deltas(docs)
                step[first] = docs[first]  # documents ascend within a pair
                yield {
                    "block": self.number,
                    "radix": part,
                    "pairs": pack(deltas(own[first])),
                    "held": pack(held),
                    "records": pack(step, count[i:j]),
                }


def _rows_to_arrow(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for row in rows:
        yield pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in schema], schema=schema)


def _arrow_to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, radixes: int) -> DataFrame:
    """Blocks of ``docs(doc_id, text)``: see ``Block.rows``."""
    schema = arrow_schema(BLOCKS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        vocabularies = Vocabularies(path_a, path_b)
        known, block = Chunks(vocabularies), Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                cut = [CUT(text) if text else [] for text in part.column(1).to_pylist()]
                new = set().union(*cut).difference(known.number)
                if new:
                    known.learn(list(new))
                for doc_id, chunks in zip(part.column(0).to_pylist(), cut):
                    block.add(doc_id, chunks, known)
                    if block.full():
                        yield from block.rows(known, radixes)
                        block = Block(block.number + 1)
                if len(known.number) > REMEMBERED:
                    yield from block.rows(known, radixes) if block.chunks else ()
                    known, block = Chunks(vocabularies), Block(block.number + 1)
                    vocabularies.words.clear()
        yield from block.rows(known, radixes) if block.chunks else ()

    return id_and_text(docs).mapInArrow(lambda batches: _rows_to_arrow(rows(batches), schema), BLOCKS)


def merged(runs: list[np.ndarray]) -> np.ndarray:
    """Two columns, pair and total, sorted by pair: a heap merge of sorted runs of such columns."""
    pairs, totals, last = [], [], -1
    for pair, n in heapq.merge(*(zip(*run.T.tolist()) for run in runs)):
        if pair == last:
            totals[-1] += n
        else:
            pairs.append(pair)
            totals.append(n)
            last = pair
    return np.array([pairs, totals], np.int64).T


def _by_radix(rows: Iterator[dict]) -> Iterator[tuple[int, Iterator[dict]]]:
    return groupby(rows, key=lambda row: row["radix"])


def count_pairs(blocks: DataFrame) -> DataFrame:
    """``(radix, pairs, answer)``: all pairs of a radix, their documents, and whether that is their first id's highest count."""
    runs = blocks.filter("radix is not null").select("radix", "pairs", "held")
    ddl = "radix int, pairs binary, answer binary"
    schema = arrow_schema(ddl)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for radix, group in _by_radix(_arrow_to_rows(batches)):
            waiting: list[np.ndarray] = []
            for row in group:
                waiting.append(np.stack([np.cumsum(unpack(row["pairs"])[0]), unpack(row["held"])[0]], axis=1))
                if len(waiting) == FAN_IN:
                    waiting = [merged(waiting)]
            pair, total = merged(waiting).T
            first = np.flatnonzero(np.diff(pair >> 16, prepend=-1))
            highest = np.repeat(np.maximum.reduceat(total, first), np.diff(first, append=len(pair)))
            yield {"radix": radix, "pairs": pack(deltas(pair)), "answer": pack(total, (total == highest) * 1)}

    dealt = runs.repartition("radix").sortWithinPartitions("radix")
    return dealt.mapInArrow(lambda batches: _rows_to_arrow(rows(batches), schema), ddl)


def answers(blocks: DataFrame, totals: DataFrame) -> DataFrame:
    """``(block, radix, answer)``: the totals of each run's pairs, and whether they are highest."""
    runs = blocks.filter("radix is not null").select("block", "radix", "pairs", F.lit(None).cast("binary").alias("answer"))
    together = totals.select(F.lit(None).cast("bigint").alias("block"), "radix", "pairs", "answer").unionByName(runs)
    ddl = "block bigint, radix int, answer binary"
    schema = arrow_schema(ddl)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for radix, group in _by_radix(_arrow_to_rows(batches)):
            whole = next(group)  # the totals come first
            pairs, (total, best) = np.cumsum(unpack(whole["pairs"])[0]), unpack(whole["answer"])
            for row in group:
                at = np.searchsorted(pairs, np.cumsum(unpack(row["pairs"])[0]))
                yield {"block": row["block"], "radix": radix, "answer": pack(total[at], best[at])}

    dealt = together.repartition("radix").sortWithinPartitions("radix", F.col("block").asc_nulls_first())
    return dealt.mapInArrow(lambda batches: _rows_to_arrow(rows(batches), schema), ddl)


def align(
    docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B, radixes: int = RADIXES
) -> tuple[DataFrame, DataFrame]:
    """Per row ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, and ``(id_a, id_b, documents, best)``.

    ``radixes`` is at most 256.
    """
    blocks = staged(aligned_blocks(docs, path_a, path_b, radixes))
    totals = staged(count_pairs(blocks))
    given = blocks.drop("pairs", "answer").withColumn("answer", F.lit(None).cast("binary"))
    together = given.unionByName(answers(blocks, totals), allowMissingColumns=True)
    order = ["block", F.col("radix").asc_nulls_first(), F.col("answer").isNull()]
    ddl = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    schema = arrow_schema(ddl)

    def finish(head: dict, n_best: np.ndarray, count_sum: np.ndarray) -> pa.RecordBatch:
        columns = head | {"n_best": n_best, "count_sum": count_sum}
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, n_best, count_sum, answer = None, None, None, None
        for row in _arrow_to_rows(batches):
            if row["radix"] is None:
                if head:
                    yield finish(head, n_best, count_sum)
                head = row
                n_best, count_sum = np.zeros((2, len(row["doc_id"])), np.int64)
            elif row["answer"] is not None:
                answer = unpack(row["answer"])
            else:
                held, (step, count) = unpack(row["held"])[0], unpack(row["records"])
                first = np.cumsum(held) - held
                docs = np.cumsum(step)
                docs -= np.repeat(docs[first] - step[first], held)
                total, best = (np.repeat(part, held) for part in answer)
                np.add.at(n_best, docs, count * best)
                np.add.at(count_sum, docs, count * total)
        if head:
            yield finish(head, n_best, count_sum)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _arrow_to_rows(batches):
            pairs, (total, best) = np.cumsum(unpack(row["pairs"])[0]), unpack(row["answer"])
            columns = [pairs >> 16, pairs & 0xFFFF, total, best.astype(bool)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, pair_schema)], schema=pair_schema)

    pair_ddl = "id_a int, id_b int, documents bigint, best boolean"
    pair_schema = arrow_schema(pair_ddl)
    per_row = together.repartition("block").sortWithinPartitions(*order).mapInArrow(run, ddl)
    return per_row, totals.mapInArrow(listed, pair_ddl)
