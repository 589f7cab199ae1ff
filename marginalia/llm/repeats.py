"""Removal of repeated byte strings by sorting covered suffixes bucket by bucket.

A suffix array of all texts would rank every byte position. Only ranks at ``length`` bytes are needed here, and a
sample of positions settles them, as in difference-cover construction: a cover sample holds a position of every
window of ``length`` bytes, at the same offset in equal windows. The cover used is the smallest hash of ``seed`` bytes
in a window (leftmost if it repeats), which is a cover by content; windows in a row with the same sample position form
a run. Then

* suffixes at sample positions fall into buckets by their first ``seed`` bytes and are sorted one bucket at a time;
* runs of one bucket that are equal all along (long ties) are not compared by bytes: the rank of such a run, a
  hash of its whole stretch that is computed once, orders it, and all but the first are repeats;
* only where a bucket holds runs of different ranks are the stretches fetched, one of each rank, and their windows
  compared with each other.

Equal runs of one batch of texts are combined before anything is shuffled, so a passage in a third of all texts leaves one
row a batch. A task holds one bucket's stretches of different rank at most; stretches are under 2 * ``length`` bytes.

A window is repeated when an equal one starts earlier: in a smaller doc_id, or in the same one at a smaller start. Every
byte of a repeated window goes; overlaps count, and windows are judged on the given texts. Null counts as empty; a
null id comes before all others; rows that repeat an id are one document, so none of them makes the same start in the
other a repeat. Texts of any length are covered, long ones in overlapping pieces. Texts shorter than a window stay whole. An empty table gives an empty table; only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import arrow_schema, batches_of, id_and_text, text_hash, text_key
from marginalia.operators.staging import staged

LENGTH, SEED = 100, 32
#: Bytes of text whose positions are hashed together, and windows that are compared together.
HELD_BYTES, HELD_WINDOWS = 1 << 21, 1 << 20
#: Bits of a key that hold a position; longer texts are cut into overlapping pieces.
POSITION_BITS = 22
#: Rows with one id are told apart by this much of their text's hash.
TAG = 0xFFFF

U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
BYTE = np.random.default_rng(7).integers(0, 1 << 64, 256, U, endpoint=False)


POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The powers of ``base`` modulo 2**64 from 0 on, at least n of them, kept for the next call."""
    if len(POWERS.get(base, ())) < n:
        out = np.full(n, base, U)
        out[0] = 1
        POWERS[base] = np.multiply.accumulate(out)
    return POWERS[base]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> U(32)) * U(0xD6E8FEB86659FD93)
    return h ^ h >> U(32)


def _spans(values: np.ndarray, width: int, combine) -> np.ndarray:
    """What ``combine`` makes of every ``width`` values in a row, by doubling; ``combine(left, right, n)``."""
    done, have, bit, n = None, 0, values, 1
    while True:
        if width & n:
            if done is None:
                done, have = bit, n
            else:
                size = len(values) - have - n + 1
                done = combine(done[:size], bit[have : have + size], n)
                have += n
        if have == width:
            return done
        bit = combine(bit[: len(bit) - n], bit[n:], n)
        n *= 2


def stretch_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch ``raw[start:end]``, by differences of one running sum."""
    n = 1 << (len(raw) + 1).bit_length()
    total = np.concatenate(([U(0)], np.cumsum(BYTE[raw] * _powers(BASE, n)[: len(raw)], dtype=U)))
    return _mixed((total[end] - total[start]) * _powers(INVERSE, n)[start])


def cover_runs(raw: np.ndarray, ends: np.ndarray, length: int = LENGTH, seed: int = SEED, bits: int = POSITION_BITS):
    """(bucket, rank, first window, last window) of every run in texts that stand one after another in ``raw``.

    Pieces of 2**bits bytes at most are taken by themselves, so that a sample's position within its piece fits the low
    bits of a key. They overlap by length - 1 bytes: each window is whole in one of them, and a run ends with its piece."""
    step = (1 << bits) - length + 1
    if step < 1:
        raise ValueError(f"pieces of 2**{bits} bytes hold no window of {length}")
    parts = []
    for at in range(0, max(len(raw) - length + 1, 1), step):
        piece = raw[at : at + step + length - 1]
        bucket, rank, first, last = _piece_runs(piece, np.clip(ends - at, 0, len(piece)), length, seed, bits)
        parts.append((bucket, rank, first + at, last + at))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _piece_runs(raw: np.ndarray, ends: np.ndarray, length: int, seed: int, bits: int):
    nothing = np.zeros(0, np.int64)
    if len(raw) < length:
        return nothing.astype(U), nothing.astype(U), nothing, nothing
    low = U((1 << bits) - 1)
    seeds = _mixed(_spans(BYTE[raw], seed, lambda a, b, n: a * U(pow(BASE, n, 1 << 64)) + b))
    keys = seeds & ~low | np.arange(len(seeds), dtype=U)
    least = _spans(keys, length - seed + 1, lambda a, b, n: np.minimum(a, b))
    starts = np.concatenate(([0], ends[:-1]))
    window = np.zeros(len(raw) + 1, np.int64)
    long = ends - starts >= length
    np.add.at(window, starts[long], 1)
    np.add.at(window, ends[long] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(window)[: len(least)])
    if not len(at):
        return nothing.astype(U), nothing.astype(U), nothing, nothing
    sample = (least[at] & low).astype(np.int64)
    cut = np.flatnonzero((np.diff(sample) != 0) | (np.diff(at) != 1) | np.isin(at[1:], starts)) + 1
    first, last = at[np.concatenate(([0], cut))], at[np.concatenate((cut - 1, [len(at) - 1]))]
    sample = sample[np.concatenate(([0], cut))]
    rank = stretch_hashes(raw, first, last + length)
    rank = _mixed(rank + (sample - first).astype(U) * U(BASE) + (last - first).astype(U) * U(INVERSE))
    return seeds[sample], rank, first, last


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching stretches as one, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(start[1:] > end[:-1]) + 1
    return start[np.concatenate(([0], new))], end[np.concatenate((new - 1, [len(end) - 1]))]


#: ``at`` holds a run's first window, the row's tag and the number of further windows: << 24, << 8, and 8 bits.
#: Rows without ``rank`` are repeats found already; their ``at`` is start << 32 | end, and ``tag`` is the row's.
RUNS = "bucket bigint, rank bigint, doc_id bigint, at bigint, tag int"


def _runs(docs: DataFrame, length: int, seed: int, bits: int) -> DataFrame:
    schema = arrow_schema(RUNS)

    def together(ids: list, texts: list[bytes], tags: list[int]) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum([len(t) for t in texts])
        raw = np.frombuffer(b"".join(texts), np.uint8)
        bucket, rank, first, last = cover_runs(raw, ends, length, seed, bits)
        if not len(bucket):
            return
        own = np.searchsorted(ends, first, side="right")
        begin = np.concatenate(([0], ends[:-1]))[own]
        named = np.array([i is not None for i in ids])[own]
        doc = np.array([i or 0 for i in ids], np.int64)[own]
        tag = np.array(tags, np.int64)[own]
        start, more = first - begin, last - first
        order = np.lexsort((start, doc, named, rank, bucket))
        same = np.concatenate(([False], (np.diff(bucket[order]) == 0) & (np.diff(rank[order]) == 0)))
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        place = [x[order] for x in (named, doc, start)]
        repeat = same & np.logical_or.reduce([x != x[lead] for x in place])
        gone = np.zeros(len(order), bool)
        gone[order] = repeat
        keep = ~gone
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[keep].view(np.int64)),
                pa.array(rank[keep].view(np.int64)),
                pa.array(doc[keep], mask=~named[keep]),
                pa.array(start[keep] << 24 | tag[keep] << 8 | more[keep]),
                pa.array(np.zeros(keep.sum(), np.int32), mask=np.ones(keep.sum(), bool)),
            ],
            schema=schema,
        )
        if gone.any():
            a, b = merged(first[gone], last[gone] + length)
            text = np.searchsorted(ends, a, side="right")
            # A stretch may touch the next text's; it is cut at the ends of texts.
            pieces = []
            for s, e, k in zip(a.tolist(), b.tolist(), text.tolist()):
                while s < e:
                    stop = min(e, int(ends[k]))
                    if s < stop:
                        zero = int(ends[k]) - len(texts[k])
                        pieces.append((k, s - zero, stop - zero))
                    s, k = stop, k + 1
            yield batches_of(
                {
                    "bucket": [int(x) for x in _mixed(np.array([p[1] ^ p[0] << 32 for p in pieces], U)).view(np.int64)],
                    "rank": [None] * len(pieces),
                    "doc_id": [ids[k] for k, _, _ in pieces],
                    "at": [s << 32 | e for _, s, e in pieces],
                    "tag": [tags[k] for k, _, _ in pieces],
                },
                schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, tags, held = [], [], [], 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                text = value.as_py() or ""
                raw = text.encode()
                if len(raw) < length:
                    continue
                if len(raw) + held > 1 << bits and held:
                    yield from together(ids, texts, tags)
                    ids, texts, tags, held = [], [], [], 0
                ids.append(doc_id.as_py())
                texts.append(raw)
                tags.append(text_hash(text) & TAG)
                held += len(raw)
                if held >= HELD_BYTES:
                    yield from together(ids, texts, tags)
                    ids, texts, tags, held = [], [], [], 0
        if texts:
            yield from together(ids, texts, tags)

    return docs.mapInArrow(run, RUNS)


def _ranked(runs: DataFrame, length: int) -> DataFrame:
    """Repeats as ``(kind 0, doc_id, tag, span)``, and runs to compare by bytes as ``(kind 1, bucket, doc_id, tag, at)``."""
    bucket = Window.partitionBy("bucket")
    tied = Window.partitionBy("bucket", "rank").orderBy("doc_id", "at")
    start = F.shiftright("at", 24)
    seen = runs.withColumns(
        {
            "several": F.min("rank").over(bucket) != F.max("rank").over(bucket),
            "lead": F.first(F.struct("doc_id", start.alias("start"), "at")).over(tied),
        }
    )
    known = F.col("rank").isNull()
    earlier = ~(F.col("lead.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("lead.start") == start))
    alone = F.col("lead.at").eqNullSafe(F.col("at")) & F.col("lead.doc_id").eqNullSafe(F.col("doc_id"))
    end = start + F.col("at").bitwiseAND(F.lit(0xFF)) + F.lit(length)
    return seen.filter(known | earlier | (F.col("several") & alone)).select(
        F.when(known | earlier, 0).otherwise(1).alias("kind"),
        F.when(~(known | earlier), F.col("bucket")).alias("bucket"),
        "doc_id",
        F.when(known, F.col("tag")).otherwise(F.shiftright("at", 8).bitwiseAND(F.lit(TAG))).cast("int").alias("tag"),
        F.when(known | ~earlier, F.col("at")).otherwise(F.shiftleft(start, 32).bitwiseOR(end)).alias("at"),
    )


def _stretches(own: DataFrame, unlike: DataFrame, length: int) -> DataFrame:
    """``(bucket, doc_id, at, stretch)`` of runs whose bucket holds unlike ones."""
    wanted = unlike.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("bucket", "at")).alias("runs"))
    wanted = wanted.select(F.col("doc_id").alias("w_id"), F.col("tag").alias("w_tag"), "runs")
    joined = own.join(wanted, own["doc_id"].eqNullSafe(wanted["w_id"]) & (own["tag"] == wanted["w_tag"]))
    ddl = "bucket bigint, doc_id bigint, at bigint, stretch binary"
    schema = arrow_schema(ddl)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            for doc_id, value, runs in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                raw = value.encode()
                for r in runs:
                    start = r["at"] >> 24
                    out["bucket"].append(r["bucket"])
                    out["doc_id"].append(doc_id)
                    out["at"].append(r["at"])
                    out["stretch"].append(raw[start : start + (r["at"] & 0xFF) + length])
            yield batches_of(out, schema)

    return joined.select("doc_id", "text", "runs").mapInArrow(cut, ddl)


def _compared(stretches: DataFrame, length: int) -> DataFrame:
    """``(doc_id, tag, at)``: repeats among the windows of unlike runs, one bucket after another."""
    ddl = "doc_id bigint, tag int, at bigint"
    schema = arrow_schema(ddl)

    def repeats(rows: list[tuple]) -> pa.RecordBatch:
        bucket = np.array([r[0] for r in rows], np.int64)
        named = np.array([r[1] is not None for r in rows])
        doc = np.array([r[1] or 0 for r in rows], np.int64)
        at = np.array([r[2] for r in rows], np.int64)
        sizes = np.array([len(r[3]) for r in rows], np.int64)
        raw = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        counts = sizes - length + 1
        own = np.repeat(np.arange(len(rows)), counts)
        further = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = (np.cumsum(sizes) - sizes)[own] + further
        window = stretch_hashes(raw, begin, begin + length)
        window = _mixed(window + bucket[own].view(U) * U(BASE))
        _, first, back = np.unique(window, return_index=True, return_inverse=True)
        lead, start = first[back], (at[own] >> 24) + further
        later = (named[own] != named[own][lead]) | (doc[own] != doc[own][lead]) | (start != start[lead])
        hit = np.flatnonzero(later)
        new = np.flatnonzero((np.diff(own[hit]) != 0) | (np.diff(start[hit]) != 1)) + 1
        a, b = np.concatenate(([0], new)), np.concatenate((new - 1, [len(hit) - 1]))
        if not len(hit):
            a = b = np.zeros(0, np.int64)
        row = own[hit[a]] if len(hit) else a
        low, high = (start[hit[a]], start[hit[b]] + length) if len(hit) else (a, a)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc[row], mask=~named[row]),
                pa.array((at[row] >> 8 & TAG).astype(np.int32)),
                pa.array(low << 32 | high),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, windows = [], 0
        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if windows >= HELD_WINDOWS and row[0] != rows[-1][0]:
                    yield repeats(rows)
                    rows, windows = [], 0
                rows.append(row)
                windows += len(row[3]) - length + 1
        if rows:
            yield repeats(rows)

    dealt = stretches.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "at")
    return dealt.mapInArrow(run, ddl)


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, bits: int = POSITION_BITS) -> DataFrame:
    """``(doc_id, tag, spans array<bigint>)``: repeated stretches of each row that has any, as start << 32 | end."""
    own = id_and_text(docs)
    found = staged(_ranked(_runs(own, length, seed, bits), length))
    tagged = own.select("doc_id", "text", text_key(F.col("text")).bitwiseAND(F.lit(TAG)).cast("int").alias("tag"))
    unlike = found.filter("kind = 1").select("bucket", "doc_id", "tag", "at")
    more = _compared(_stretches(tagged.filter("text is not null"), unlike, length), length)
    spans = found.filter("kind = 0").select("doc_id", "tag", "at").unionByName(more)
    return spans.groupBy("doc_id", "tag").agg(F.collect_list("at").alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, bits: int = POSITION_BITS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept binary)`` of every row of ``docs(doc_id, text)``."""
    ddl = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    schema = arrow_schema(ddl)
    own = id_and_text(docs).select(
        "doc_id", "text", text_key(F.col("text")).bitwiseAND(F.lit(TAG)).cast("int").alias("tag")
    )
    spans = repeated_spans(docs, length, seed, bits)
    spans = spans.select(F.col("doc_id").alias("s_id"), F.col("tag").alias("s_tag"), "spans")
    joined = own.join(spans, own["doc_id"].eqNullSafe(spans["s_id"]) & (own["tag"] == spans["s_tag"]), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            out["doc_id"] = batch.column(0).to_pylist()
            for text, own in zip(batch.column(1), batch.column(2)):
                raw, gone = (text.as_py() or "").encode(), np.array(own.as_py() or [], np.int64)
                start, end = merged(gone >> 32, gone & 0xFFFFFFFF)
                kept, at = [], 0
                for a, b in zip(start.tolist(), end.tolist()):
                    kept.append(raw[at:a])
                    at = b
                kept = b"".join([*kept, raw[at:]])
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(kept))
                out["n_spans"].append(len(start))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept)
            yield batches_of(out, schema)

    return joined.select("doc_id", "text", "spans").mapInArrow(cut, ddl)
