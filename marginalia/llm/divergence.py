"""How far the sources of a language are apart, by the words they use: exact chi-square-like divergences.

Chunk factorisation: a task counts the white-space chunks of each document. Each chunk of a block of documents is cut into
terms once, and its terms are joined back to the documents that hold it, which tells documents apart where several chunks
give one term. A block hands on one row per source and term, and a document is in one block, so the rows' documents add
up. They are shuffled once, by language and term; no row per document or chunk is, and the commonest term has as many
rows as blocks have sources. Only terms of enough documents are written.

Sources are compared in tiles of ``TILE`` by ``TILE`` of a language: terms come in buckets, each adds to a matrix, and a
term that neither source of a tile pair holds is added by number, as all such terms give the same. The output has a row
for every two sources, so only there is work quadratic.

Null text, language and source count as empty strings, and an empty language is one like any other. Texts of any length are
processed whole, in a block of their own if need be. Rows that repeat count each; an empty table gives an empty one. Only
the three columns are read, whatever others are there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import arrow_schema
from marginalia.operators.staging import staged

#: Runs of letters and of any characters beyond ASCII, in text whose A-Z are lower-cased.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP = 10
#: ``TERM`` on bytes that are lower-cased: all others that no term holds are spaces, but the line feed stays.
TERM_BYTES = bytes(b if b == 10 or b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: Pairs of document and chunk in a block, documents, and bytes of text, beyond which the next document starts a new one.
BLOCK_PAIRS, BLOCK_DOCUMENTS, BLOCK_BYTES = 4_000_000, 1 << 16, 1 << 27
#: Rows handed on together.
TOGETHER = 100_000
#: Sources in a tile, and buckets of terms for each pair of tiles.
TILE, TERM_BUCKETS = 64, 64

FOUND = "lang string, source string, term string, documents bigint, n bigint"


def _cut(chunks: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of chunks without white space, sorted; the numbers of all terms in order, and how many each chunk has."""
    lines = b"\n".join(chunks).translate(TERM_BYTES)
    index: defaultdict = defaultdict()
    index.default_factory = index.__len__
    words = lines.split()
    term = np.fromiter(map(index.__getitem__, words), np.int32, len(words))
    held = np.frombuffer(lines, np.uint8) > 32
    starts = np.flatnonzero(held[1:] & ~held[:-1]) + 1
    starts = np.append(0, starts) if len(held) and held[0] else starts
    chunk = np.searchsorted(np.flatnonzero(np.frombuffer(lines, np.uint8) == 10), starts)
    terms = pa.array(list(index), pa.binary())
    order = np.asarray(pc.sort_indices(terms))
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    return terms.take(pa.array(order)).cast(pa.string()), place[term], np.bincount(chunk, minlength=len(chunks))


class Block:
    """Documents of one task: how often each has each chunk."""

    def __init__(self) -> None:
        self.pairs = self.size = 0
        self.index: defaultdict = defaultdict()
        self.index.default_factory = self.index.__len__
        self.groups: defaultdict = defaultdict()
        self.groups.default_factory = self.groups.__len__
        self.chunks, self.counts, self.group = [], [], []

    def add(self, lang: str, source: str, text: bytes) -> None:
        words = text.lower().split()
        chunks, counts = np.unique(np.fromiter(map(self.index.__getitem__, words), np.int32, len(words)), return_counts=True)
        self.chunks.append(chunks)
        self.counts.append(counts)
        self.group.append(self.groups[lang, source])
        self.pairs += len(chunks)
        self.size += len(text)

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row per source and term: its documents with the term, the term's occurrences there."""
        if not self.index:
            return
        terms, term, width = _cut(list(self.index))
        first = np.cumsum(width) - width
        # Documents by group: those of a term and group then follow each other.
        by_group = np.argsort(self.group, kind="stable")
        group, many = np.array(self.group)[by_group], len(by_group)
        place = np.empty(many, np.int64)
        place[by_group] = np.arange(many)
        doc = np.repeat(place, [len(c) for c in self.chunks])
        chunk, n = np.concatenate(self.chunks), np.concatenate(self.counts)
        each = width[chunk]
        at = np.repeat(first[chunk] - np.cumsum(each) + each, each) + np.arange(each.sum())
        key, n = term[at] * np.int64(many) + np.repeat(doc, each), np.repeat(n, each)
        del at, doc, chunk, each
        if not len(key):
            return
        order = np.argsort(key)
        key, n = key[order], n[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        key, n = key[starts], np.add.reduceat(n, starts)
        term, own = key // many, group[key % many]
        starts = np.flatnonzero(np.diff(term * len(self.groups) + own, prepend=-1))
        documents, n = np.diff(starts, append=len(key)), np.add.reduceat(n, starts)
        term, own = term[starts], own[starts]
        langs, sources = (pa.array(names, pa.string()) for names in zip(*self.groups))
        for start in range(0, len(starts), TOGETHER):
            part = slice(start, start + TOGETHER)
            columns = {
                "lang": langs.take(pa.array(own[part])),
                "source": sources.take(pa.array(own[part])),
                "term": terms.take(pa.array(term[part])),
                "documents": pa.array(documents[part]),
                "n": pa.array(n[part]),
            }
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)


def terms_by_block(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, documents, n)`` of every block of ``docs(lang, source, text)``, all without nulls: see ``Block.rows``."""
    schema = arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                block.add(lang, source, text)
                if block.pairs >= BLOCK_PAIRS or len(block.group) == BLOCK_DOCUMENTS or block.size >= BLOCK_BYTES:
                    yield from block.rows(schema)
                    block = Block()
        yield from block.rows(schema)

    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(run, FOUND)


def kept_terms(found: DataFrame, min_documents: int) -> DataFrame:
    """``(lang, source, term, n, lang_n, first)`` of terms in ``min_documents`` documents of their language: occurrences in the source, in the language.

    ``first`` holds for one source of each language and term.
    """
    of_term = Window.partitionBy("lang", "term")
    sums = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("n"))
    sums = sums.select(
        "lang",
        "source",
        "term",
        "n",
        F.sum("n").over(of_term).alias("lang_n"),
        (F.min("source").over(of_term) == F.col("source")).alias("first"),
        F.sum("documents").over(of_term).alias("documents"),
    )
    return sums.filter(F.col("documents") >= min_documents).drop("documents")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exactly."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n + F.lit(2)).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", scaled, (total + 2 * terms).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _compare_tiles(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, a, b, value, seen)`` for source numbers ``a < b``: the summed divergences of terms that the tiles of either hold, and how many."""
    held = groups.select("lang", "number", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "tiles")
    every = held.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(TERM_BUCKETS - 1))))
    bucket = F.pmod(F.xxhash64("term"), F.lit(TERM_BUCKETS)).cast("int")
    rows = every.unionByName(cells.select("lang", "number", "term", "p", "tiles").withColumn("bucket", bucket))
    tile = F.floor(F.col("number") / TILE)
    rows = rows.select("lang", "bucket", "number", "term", "p", tile.alias("own"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    rows = rows.select("lang", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "bucket", "number", "term", "p")
    keys = ["lang", "x", "y", "bucket"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("term").asc_nulls_first(), "number")
    ddl = "lang string, a bigint, b bigint, value bigint, seen bigint"
    schema = arrow_schema(ddl)
    many = 2048  # terms that are compared together

    class Tiles:
        """The matrix of one pair of tiles and one bucket."""

        def __init__(self, key: tuple):
            self.lang, self.x, self.y, _ = key
            self.numbers, self.p0, self.value, self.seen = np.zeros(0, np.int64), np.zeros(0, np.int64), None, 0
            self.cells: list[tuple[np.ndarray, ...]] = []
            self.terms, self.last = 0, None

        def add(self, number: np.ndarray, term: pa.Array, p: np.ndarray) -> None:
            """Rows that follow those added: first the sources by number, without a term, then the cells by term."""
            heads = term.null_count
            self.numbers, self.p0 = np.append(self.numbers, number[:heads]), np.append(self.p0, p[:heads])
            if heads == len(term):
                return
            term = term.slice(heads)
            code = np.asarray(term.dictionary_encode().indices)
            again = self.terms > 0 and term[0].as_py() == self.last
            row = self.terms - again + np.cumsum(np.diff(code, prepend=code[0]) != 0)
            self.cells.append((row, number[heads:], p[heads:]))
            self.terms, self.last = int(row[-1]) + 1, term[-1].as_py()
            if self.terms > many:
                self.flush(self.terms - 1)  # the last one's rows may go on

        def flush(self, terms: int) -> None:
            row, number, own = (np.concatenate(c) for c in zip(*self.cells)) if self.cells else np.zeros((3, 0), np.int64)
            now = row < terms
            p = np.tile(self.p0, (terms, 1))
            p[row[now], np.searchsorted(self.numbers, number[now])] = own[now]
            is_left, is_right = self.numbers // TILE == self.x, self.numbers // TILE == self.y
            self.left, self.right = self.numbers[is_left], self.numbers[is_right]
            q = p[:, is_right]
            value = np.zeros((len(self.left), len(self.right)), np.int64)
            for k, column in enumerate(p[:, is_left].T):
                value[k] = ((column[:, None] - q) ** 2 // (column[:, None] + q)).sum(axis=0)
            self.value = value if self.value is None else self.value + value
            self.seen += terms
            self.cells, self.terms = [(row[~now] - terms, number[~now], own[~now])], self.terms - terms

        def out(self) -> pa.RecordBatch:
            self.flush(self.terms)
            k, m = np.nonzero(self.left[:, None] < self.right[None, :])
            columns = [[self.lang] * len(k), self.left[k], self.right[m], self.value[k, m], np.full(len(k), self.seen)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tiles = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [np.asarray(batch.column(c).dictionary_encode().indices) for c in keys]
            starts = np.flatnonzero(np.any([np.diff(c, prepend=-1) != 0 for c in codes], axis=0))
            number, p = (np.asarray(batch.column(c)) for c in ("number", "p"))
            for start, end in zip(starts, np.append(starts[1:], batch.num_rows)):
                own = tuple(batch.column(c)[start].as_py() for c in keys)
                if key != own:
                    if tiles:
                        yield tiles.out()
                    key, tiles = own, Tiles(own)
                tiles.add(number[start:end], batch.column("term").slice(start, end - start), p[start:end])
        if tiles:
            yield tiles.out()

    sums = dealt.mapInArrow(run, ddl).groupBy("lang", "a", "b")
    return sums.agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``docs(lang, source, text)``.

    Part ``pair`` compares a source with each other one of its language over all terms in at least ``min_documents`` documents of the
    language; part ``term`` lists the ``top`` terms that a source has more of than its language.
    """
    given = docs.select(*(F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")))
    by_source = staged(kept_terms(terms_by_block(given), min_documents))

    totals = by_source.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = by_source.groupBy("lang").agg(F.count_if("first").alias("terms"))
    numbered = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = given.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.fillna(0, ["total", "terms"]).withColumn("number", numbered.cast("bigint"))
    per_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))
    groups = groups.join(per_lang, "lang")
    p0 = F.when(F.col("terms") > 0, share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms")))
    groups = staged(groups.withColumn("p0", p0))

    cells = by_source.join(groups, ["lang", "source"])
    cells = cells.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    more = cells.withColumn("q", q).filter("p > q")
    by_term = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))

    sums = _compare_tiles(cells, groups.filter("terms > 0"))
    one = groups.select("lang", "terms", F.col("number").alias("a"), F.col("source").alias("source_a"), F.col("p0").alias("p_a"))
    two = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("source_b"), F.col("p0").alias("p_b"))
    pairs = one.join(two, "lang").filter("a < b").join(sums, ["lang", "a", "b"], "left")
    others = (F.col("terms") - F.coalesce("seen", F.lit(0))) * divergence(F.col("p_a"), F.col("p_b"))
    pairs = pairs.withColumn("value", F.when(F.col("terms") > 0, F.coalesce("value", F.lit(0)) + others).otherwise(0))
    sides = F.array(*(F.struct(F.col(f"source_{s}").alias("source"), F.col(f"source_{o}").alias("item")) for s, o in ("ab", "ba")))
    pairs = pairs.select("lang", F.explode(sides).alias("s"), "value")
    pairs = pairs.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")

    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = by_term.withColumn("rank", ranked).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", ranked).unionByName(best)
