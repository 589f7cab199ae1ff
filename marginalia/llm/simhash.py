"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits both lie within ceil(r / 2) bits of a third one. So every distinct
fingerprint emits all variants of itself within that half radius, variants meet in a shuffle, and what meets is
deduplicated and verified. A variant gathers at most the fingerprints of its own ball, however many
documents there are, and copies count once, so no key is hot. For an even radius all that meet are
within the radius of each other, and links between neighbours in order connect them as well as all pairs would.

Fingerprints may have several blocks, which are compared one by one: then documents are candidates when
any block is within the radius, and the caller verifies them on their texts.

No ball of a feasible size holds texts of a five-word similarity of 0.8: they differ in about ten of 64 bits, and
half of that has eight million variants. ``near_copies`` therefore adds candidates from bands of min-wise shingle hashes to those
of the ball, and verifies all by exact Jaccard similarity of their texts' shingle sets. A pair at the least similarity shares
one of the bands with a chance of 99.8 %. In a bucket each text first meets the text that shares most bands with others (for
copies of one text, that text), which joins a crowd of copies without its pairs. Texts of buckets, or of linked fingerprints, that are then
still in several components are compared by a prefix-filtered join: a pair of the least similarity shares one of the rarest fifth of
either's shingles, which texts with many shingles of their own never do. So no two texts that share a band stay
apart unverified, and none meets all of its crowd.

Null and empty texts have the fingerprint zero and link like any other. Rows that repeat an id are one document;
a null id keeps its row but names no component, unless nothing in the component has an id. An empty table gives an empty
table; only id and text are read; texts are processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import arrow_schema, batches_of, id_and_text, text_hash
from marginalia.llm.components import components
from marginalia.operators.staging import staged

#: A-Z to lower case, bytes else as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bands of min-wise hashes and hashes in each.
BANDS, ROWS = 16, 5
#: Odd numbers, each of which permutes 64-bit hashes.
MULTIPLIERS = np.random.default_rng(11).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: About how many texts of a bucket meet in one task.
CROWD = 10_000


def lower_words(text: str | None) -> list[bytes]:
    return text.encode().translate(LOWER).split() if text else []


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Unsigned XXH64 (seed 42) of all runs of ``size`` words, repeats included; of all words if fewer."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(whole, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.array([digest(whole[a:b], 42) for a, b in spans], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes), bitorder="little").view(np.uint64)[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, fp bigint)`` of every row: the 64-bit SimHash of its word shingles."""
    schema = "doc_id bigint, fp bigint"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [signed(majority(shingle_hashes(text.as_py(), words))) for text in batch.column(1)]
            yield batches_of({"doc_id": batch.column(0).to_pylist(), "fp": marks}, arrow)

    return id_and_text(docs).mapInArrow(run, schema)


def ball(bits: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``bits`` bits, as signed 64-bit numbers."""
    return [signed(sum(1 << i for i in c)) for r in range(radius + 1) for c in combinations(range(bits), r)]


def links(distinct: DataFrame, radius: int, bits: int = 64) -> DataFrame:
    """Edges ``(a, b)``, a < b, between fingerprints of ``distinct(fp)``, whose components are those of all pairs
    that differ in at most ``radius`` bits."""
    masks = F.array(*[F.lit(m).cast("bigint") for m in ball(bits, (radius + 1) // 2)])
    variants = distinct.select(F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp")))).alias("v"), "fp")
    if radius % 2 == 0:  # what meets is close enough
        before = F.lag("fp").over(Window.partitionBy("v").orderBy("fp"))
        met = variants.select(before.alias("a"), F.col("fp").alias("b")).filter("a is not null")
    else:
        sets = variants.groupBy("v").agg(F.sort_array(F.collect_list("fp")).alias("fps")).filter("size(fps) > 1")
        one = sets.select("fps", F.posexplode("fps").alias("i", "a"))
        met = one.select("a", F.explode(F.expr("slice(fps, i + 2, size(fps))")).alias("b"))
    return met.distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def classes(marked: DataFrame, radius: int) -> DataFrame:
    """``(fp, component_id)`` for every distinct fingerprint of ``marked(doc_id, fp)``."""
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    rooted = components(links(distinct.select("fp"), radius))
    own = distinct.join(rooted, distinct["fp"] == rooted["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    own = staged(own)
    firsts = staged(own.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return staged(own.join(firsts, "root").select("fp", "component_id"))


def near_duplicates(docs: DataFrame, radius: int = 2, words: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row; the component is named by its smallest doc_id."""
    marked = staged(fingerprints(docs, words))
    return marked.join(classes(marked, radius), "fp").select("doc_id", "fp", "component_id")


def min_wise(hashes: np.ndarray) -> np.ndarray:
    """The smallest of the hashes under each of ``BANDS * ROWS`` permutations."""
    return np.array([(hashes * m).min() for m in MULTIPLIERS], np.uint64)


def sketches(docs: DataFrame, words: int = 5) -> DataFrame:
    """``(doc_id, fp, same, units, bands, sig)`` of every row: SimHash, hash of the words, number of different shingles,
    one hash per band, a byte per minimum."""
    schema = "doc_id bigint, fp bigint, same bigint, units int, bands array<bigint>, sig binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in arrow.names}
            out["doc_id"] = batch.column(0).to_pylist()
            for value in batch.column(1):
                text = value.as_py()
                hashes = shingle_hashes(text, words)
                least = min_wise(hashes) if len(hashes) else np.zeros(0, np.uint64)
                out["fp"].append(signed(majority(hashes)))
                out["same"].append(signed(xxhash.xxh64_intdigest(b" ".join(lower_words(text)), 7)))
                out["units"].append(len(np.unique(hashes)))
                rows = least.reshape(-1, ROWS)
                out["bands"].append([signed(xxhash.xxh64_intdigest(r.tobytes(), j)) for j, r in enumerate(rows)])
                out["sig"].append((least & np.uint64(255)).astype(np.uint8).tobytes())
            yield batches_of(out, arrow)

    return id_and_text(docs).mapInArrow(run, schema)


def buckets(distinct: DataFrame) -> DataFrame:
    """``(key, n, part, id, units)``: the texts of ``distinct(id, units, bands)`` in each bucket that at least two share.

    ``n`` is the bucket's size; ``part`` deals a crowded bucket over several tasks by a hash of the id.
    """
    rows = distinct.select("id", "units", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return rows.join(sizes, "key").select("key", "n", F.pmod(F.xxhash64("id"), parts()).alias("part"), "id", "units")


def parts() -> Column:
    return F.floor(F.col("n") / CROWD) + 1


def met_in_stars(shared: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: in each bucket all texts with the one that shares most bands with others; pairs may repeat."""
    weights = shared.groupBy("id").agg(F.sum("n").alias("weight"))
    first = F.max(F.struct("weight", "id", "units", "n")).alias("h")
    hubs = staged(shared.join(weights, "id").groupBy("key").agg(first).select("key", "h.n", "h.id", "h.units"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), parts() - 1)).alias("part")
    dealt = hubs.select("key", every, F.col("id").alias("a"), F.col("units").alias("units_a"))
    fits = F.least("units", "units_a") >= similarity * F.greatest("units", "units_a")
    return shared.join(dealt, ["key", "part"]).filter(fits).select("a", F.col("id").alias("b"))


def still_apart(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """``(id, root)`` of the texts of ``shared(key, n, id)`` in buckets of three or more whose texts are in several components."""
    rooted = shared.filter("n > 2").join(labels.select(F.col("node").alias("id"), "root"), "id", "left")
    rooted = rooted.select("key", "id", F.coalesce("root", "id").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    return rooted.join(mixed.select("key"), "key").select("id", "root").distinct()


def met_in_prefixes(apart: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """``(a, b)`` of texts of ``apart(id, root)`` with different roots that may have this similarity; pairs may repeat.

    Shingles are ordered by how many of these texts hold them. Of two texts that are similar enough, the prefixes, all
    but the last ``similarity`` of the shingles and one more, have a shingle in common, and what is left behind their first
    common one must suffice. Shingles that no other text holds come first and need not be joined.
    """
    own = id_and_text(docs)
    texts = own.join(apart.select(F.col("id").alias("k_id")), own["doc_id"] == F.col("k_id"), "left_semi")
    schema = "id bigint, t bigint, units int, hashes array<bigint>"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in arrow.names}
            out["id"] = batch.column(0).to_pylist()
            for value in batch.column(1):
                text = value.as_py()
                hashes = np.unique(shingle_hashes(text, words))
                out["t"].append(text_hash(text))
                out["units"].append(len(hashes))
                out["hashes"].append(hashes.view(np.int64))
            yield batches_of(out, arrow)

    # An id may come with several texts; equal rows are one.
    sets = staged(texts.mapInArrow(run, schema).dropDuplicates(["id", "t"]))
    held = sets.select("id", "t", "units", F.explode("hashes").alias("h"))
    counts = held.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    listed = held.join(counts, "h").groupBy("id", "t", "units").agg(F.array_sort(F.collect_list(F.struct("n", "h"))).alias("hs"))
    alone = F.col("units") - F.size("hs")
    prefix = F.col("units") - F.ceil(F.lit(similarity) * F.col("units") - 1e-6) + 1
    marks = F.slice("hs", F.lit(1), F.greatest(F.lit(0), F.least(F.size("hs"), (prefix - alone).cast("int"))))
    placed = listed.select("id", "units", alone.alias("alone"), F.posexplode(marks).alias("at", "m"))
    # What is left from this shingle on, itself included.
    left = (F.col("units") - F.col("alone") - F.col("at")).alias("rest")
    own_part = F.pmod(F.xxhash64("id"), parts()).alias("part")
    marked = staged(placed.select("id", "units", left, F.col("m.h").alias("h"), F.col("m.n").alias("n")).join(apart, "id"))
    ones = marked.select("h", own_part, F.col("id").alias("b"), F.col("units").alias("units_b"), F.col("rest").alias("rest_b"), F.col("root").alias("root_b"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), parts() - 1)).alias("part")
    others = marked.select("h", every, F.col("id").alias("a"), F.col("units").alias("units_a"), F.col("rest").alias("rest_a"), F.col("root").alias("root_a"))
    needed = similarity / (1 + similarity) * (F.col("units_a") + F.col("units_b")) - 1e-6
    fits = (F.least("rest_a", "rest_b") >= needed) & (F.col("root_a") < F.col("root_b"))
    return ones.join(others, ["h", "part"]).filter(fits).select("a", "b")


def met_in_balls(distinct: DataFrame, linked: DataFrame) -> DataFrame:
    """``(a, b)`` of texts of ``distinct(id, fp)`` whose fingerprints are ``linked``, as a chain or star."""
    firsts = staged(distinct.groupBy("fp").agg(F.min("id").alias("first")))
    left = firsts.select(F.col("fp").alias("a"), F.col("first").alias("first_a"))
    right = firsts.select(F.col("fp").alias("b"), F.col("first").alias("first_b"))
    between = linked.join(left, "a").join(right, "b").select("first_a", "first_b")
    return distinct.join(firsts, "fp").select("first", "id").union(between).toDF("a", "b")


def linked_crowds(distinct: DataFrame, linked: DataFrame) -> DataFrame:
    """``(key, n, id)`` of the texts of ``distinct(id, fp)``: fingerprints are one bucket if ``linked``, directly or by others.

    A chain or star stands for a ball's pairs only while every pair counts. Where a text in it fails, those behind it must meet too.
    """
    rooted = components(linked)
    rows = distinct.join(rooted, distinct["fp"] == rooted["node"], "left").select(F.coalesce("root", "fp").alias("key"), "id")
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 2")
    return staged(rows.join(sizes, "key").select("key", "n", "id"))


def likely(pairs: DataFrame, distinct: DataFrame, least: float) -> DataFrame:
    """The ``(a, b)`` whose signatures agree in a share of ``least`` places."""
    left = distinct.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
    right = distinct.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
    schema = "a bigint, b bigint"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8) for k in (2, 3)]
            agree = (sides[0] == sides[1]).reshape(batch.num_rows, -1).mean(1) if batch.num_rows else np.zeros(0)
            chosen = batch.filter(pa.array(agree >= least))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], schema=arrow)

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b")
    return met.filter("length(sig_a) > 0 and length(sig_b) > 0").mapInArrow(run, schema)


def verified(pairs: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The ``(a, b)`` of which a text of each has at least this Jaccard similarity of shingle sets."""
    wanted = staged(pairs.select("a").union(pairs.select("b")).distinct().toDF("k_id"))
    own = id_and_text(docs)
    # Equal rows of one id are one text; dealt by id once, for this and for the joins.
    texts = (
        own.join(wanted, own["doc_id"] == wanted["k_id"], "left_semi")
        .repartition(F.col("doc_id")).dropDuplicates(["doc_id", "text"])
    )
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    schema = "a bigint, b bigint"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, two = (np.unique(shingle_hashes(t.as_py(), words)) for t in (x, y))
                shared = len(np.intersect1d(one, two, assume_unique=True))
                good.append(shared > 0 and shared >= similarity * (len(one) + len(two) - shared))
            chosen = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], schema=arrow)

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return met.mapInArrow(run, schema).distinct()


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 2) -> DataFrame:
    """``(doc_id, component_id)`` of every row with an id: texts with equal lower-cased words are linked, and texts whose
    shingle sets have at least this similarity; the component is named by its smallest doc_id."""
    own = id_and_text(docs).filter("doc_id is not null")
    marked = staged(sketches(own, words))
    same = ("same", "fp")
    distinct = staged(
        marked.groupBy(*same).agg(
            F.min("doc_id").alias("id"), F.first("units").alias("units"),
        F.first("bands").alias("bands"), F.first("sig").alias("sig"),
        )
    )
    shared = staged(buckets(distinct))

    def judged(met: DataFrame) -> DataFrame:
        pairs = met.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        near = staged(likely(staged(pairs), distinct, similarity - 0.2).distinct())
        return staged(verified(near, own, words, similarity))

    linked = staged(links(distinct.select("fp").distinct(), radius))
    edges = judged(met_in_stars(shared, similarity).union(met_in_balls(distinct, linked)))
    crowds = shared.select("key", "n", "id").union(linked_crowds(distinct, linked))
    apart = staged(still_apart(crowds, components(edges)))
    rooted = components(edges.union(judged(met_in_prefixes(apart, own, words, similarity))))
    named = distinct.join(rooted, distinct["id"] == rooted["node"], "left").select(
        *same, F.coalesce("root", "id").alias("component_id")
    )
    return marked.select("doc_id", *same).join(staged(named), list(same)).select("doc_id", "component_id")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose document names its component of near copies, with all their columns; rows without
    an id stay."""
    others = near_copies(docs, words, similarity).filter("component_id <> doc_id").select(F.col("doc_id").alias("k_id"))
    others = staged(others.distinct())
    return docs.join(others, docs["doc_id"] == others["k_id"], "left_anti")
