"""Document fingerprints as homomorphic multiset hashes.

A text is cut into paragraphs at line feeds, and a paragraph at its sentence and clause ends, so that a text of
one paragraph still has parts to compare. Each part is hashed to a wide vector of ``LANES`` bytes, and the
vectors are added modulo 2**32, along with the number of parts. The sum does not depend on the order of parts; adding or
subtracting the vector of a part inserts or deletes it, without the rest of the text. Equal texts have equal
fingerprints. As the bytes of different parts are independent, the inner product of two centred sums estimates the
size of the common multiset, and its cosine is the likeness of two fingerprints: 1 for equal ones, about the
common share otherwise, with a standard error near 1 / sqrt(LANES).

Null counts as the empty text, whose fingerprint is zero; it is like itself and unlike any other. Texts
are processed whole. Only DataFrame functions are used, within one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import id_and_text

LANES = 64
MODULUS = 1 << 32
#: Parts that are hashed to vectors together; below 2**23, beyond which the sums of their bytes leave a lane.
SLICE = 1 << 16
#: Ends of parts; white space after one belongs to neither side.
PART_END = r"\n+|(?<=[.!?;:,])\s+"
#: Buckets per shuffle partition of the order of documents.
BUCKETS_PER_PARTITION = 4


def parts(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), PART_END), lambda p: F.length(p) > 0)


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _adder(shift: int):
    return lambda total, h: total + F.shiftright(h, shift).bitwiseAND(F.lit(0x000000FF000000FF))


def fingerprint(text: Column) -> Column:
    """array<bigint>: the number of parts, then two lanes in each number, the upper one shifted by 32 bits.

    Bytes of a lane add up without reaching the upper lane within a slice; between slices each lane is reduced.
    """
    hashes = F.transform(parts(text), lambda p: F.xxhash64(p))
    return let(hashes, lambda own: F.concat(F.array(F.size(own).cast("bigint")), _total(own)))


def _total(hashes: Column) -> Column:
    """The packed lanes of all parts, a slice of them at a time."""
    last = F.greatest(F.floor((F.size(hashes) - 1) / SLICE), F.lit(0)).cast("int")
    zero = F.array_repeat(F.lit(0).cast("bigint"), LANES // 2)

    def with_slice(total: Column, number: Column) -> Column:
        own = F.slice(hashes, number * SLICE + 1, F.lit(SLICE))
        return let(_wide(own), lambda words: F.zip_with(total, F.array(*_sums(words)), _add_packed))

    return F.aggregate(F.sequence(F.lit(0), last), zero, with_slice)


def _add_packed(a: Column, b: Column) -> Column:
    """Both lanes of two numbers added, each modulo 2**32."""
    low = F.lit(MODULUS - 1)
    upper = (F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32)).bitwiseAND(low)
    return F.shiftleft(upper, 32).bitwiseOR((a.bitwiseAND(low) + b.bitwiseAND(low)).bitwiseAND(low))


def _wide(hashes: Column) -> Column:
    """Eight bytes of every part's vector in each number: one array for each eight lanes."""
    return F.array(*[F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k))) for k in range(LANES // 8)])


def _sums(words: Column) -> list[Column]:
    return [
        F.aggregate(F.get(words, k), F.lit(0).cast("bigint"), _adder(shift))
        for k in range(LANES // 8)
        for shift in (0, 8, 16, 24)
    ]


def lanes(packed: Column) -> Column:
    """array<bigint>: the number of parts and all lanes, each modulo 2**32."""
    low = F.lit(MODULUS - 1)
    rest = F.slice(packed, 2, LANES // 2)
    return F.concat(
        F.array(F.element_at(packed, 1).bitwiseAND(low)),
        F.transform(rest, lambda w: w.bitwiseAND(low)),
        F.transform(rest, lambda w: F.shiftrightunsigned(w, 32)),
    )


def insert(whole: Column, part: Column) -> Column:
    """The lanes of a multiset together with another one."""
    return F.zip_with(whole, part, lambda a, b: (a + b).bitwiseAND(F.lit(MODULUS - 1)))


def delete(whole: Column, part: Column) -> Column:
    """The lanes of a multiset without a part of it."""
    return F.zip_with(whole, part, lambda a, b: (a - b).bitwiseAND(F.lit(MODULUS - 1)))


def as_text(packed: Column) -> Column:
    """Sixteen hexadecimal digits for each number of a fingerprint."""
    return F.lower(F.array_join(F.transform(packed, lambda v: F.lpad(F.hex(v), 16, "0")), ""))


def centred(own: Column) -> Column:
    """The lanes as doubles, less their expectation, from -2**31 to 2**31."""
    mean = F.element_at(own, 1).cast("double") * 127.5
    return F.transform(
        F.slice(own, 2, LANES),
        lambda v: F.pmod(v.cast("double") - mean + F.lit(MODULUS / 2.0), F.lit(float(MODULUS))) - F.lit(MODULUS / 2.0),
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def likeness(own: Column, other: Column) -> Column:
    """0 to 1, from two fingerprints as lanes."""
    both = F.struct(centred(own).alias("a"), centred(other).alias("b"))
    cosine = let(both, lambda v: _dot(v["a"], v["b"]) / F.sqrt(_dot(v["a"], v["a"]) * _dot(v["b"], v["b"])))
    either_empty = (F.element_at(own, 1) == 0) | (F.element_at(other, 1) == 0)
    return (
        F.when(own == other, 1.0)
        .when(either_empty, 0.0)
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))
    )


def _bucket(key: Column, splits: list) -> Column:
    """How many of the 2**n - 1 sorted splits are below ``key``, by n steps of halving."""
    levels = (len(splits) + 1).bit_length() - 1
    held = F.array(*[F.lit(s).cast("bigint") for s in splits])
    steps = F.array(*[F.lit(1 << j) for j in reversed(range(levels))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.element_at(held, at + step) < key, at + step).otherwise(at)
    )


def _splits(docs: DataFrame, buckets: int) -> list:
    levels = max(1, buckets.bit_length() - 1)
    shares = [k / (1 << levels) for k in range(1, 1 << levels)]
    return docs.agg(F.percentile_approx("doc_id", shares, 100 * len(shares)).alias("q")).first().q or []


def with_next(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` and ``next``, a struct of the next row's other columns in descending doc_id.

    After the last row comes the first; among rows of one id the order is that of their text. A row without
    an id has no place in that order, and its ``next`` is null. The rows are cut into buckets at quantiles of the id,
    and each bucket also gets the first rows of the one after it, so no task sees more than a bucket.
    """
    spark = docs.sparkSession
    named, nameless = docs.filter("doc_id is not null"), docs.filter("doc_id is null")
    own = F.struct(*[c for c in docs.columns if c != "doc_id"])
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = _splits(docs.select("doc_id"), BUCKETS_PER_PARTITION * partitions)
    if not splits:  # no row has an id
        return docs.withColumn("next", F.when(F.lit(False), own))
    placed = named.withColumn("bucket", _bucket(F.col("doc_id"), splits))
    tops = {
        r.bucket: r.top
        for r in docs.select("doc_id").filter("doc_id is not null").withColumn("bucket", _bucket(F.col("doc_id"), splits))
        .groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()
    }
    used = sorted(tops)
    before = dict(zip(used, [*used[1:], used[0]]))  # the bucket that ends where this one's top stands
    to = F.create_map(*[F.lit(x) for b in used for x in (tops[b], before[b])])
    first = F.col("doc_id").isin([tops[b] for b in used])
    both = placed.withColumn("sentinel", F.lit(0)).withColumn(
        "to", F.explode(F.when(first, F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("s")),
                                              F.struct(to[F.col("doc_id")].alias("b"), F.lit(1).alias("s"))))
                        .otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("s")))))
    )
    both = both.select(*docs.columns, F.col("to.b").alias("bucket"), F.col("to.s").alias("sentinel"))
    order = Window.partitionBy("bucket").orderBy("sentinel", F.col("doc_id").desc(), "text")
    led = both.withColumn("next", F.lead(own).over(order)).filter("sentinel = 0").drop("bucket", "sentinel")
    return led.unionByName(nameless.withColumn("next", F.when(F.lit(False), own)))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs(doc_id, text)`` and of its edited text, and their likenesses.

    The edited text has the last floor(n / 2) of n code points replaced by the first as many of the next
    document's text; a row without id has no next document, and nothing replaces them.
    """
    own = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = with_next(own.withColumn("mark", fingerprint(F.col("text"))))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = placed.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.concat(
            F.substring("text", F.lit(1), F.length("text") - half),
            F.coalesce(F.substring(F.col("next.text"), F.lit(1), half), F.lit("")),
        ).alias("edited"),
        F.col("mark"),
        F.coalesce(F.col("next.mark"), F.array_repeat(F.lit(0).cast("bigint"), 1 + LANES // 2)).alias("next_mark"),
    )
    marked = edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "mark",
        fingerprint(F.col("edited")).alias("edited_mark"),
        "next_mark",
    ).withColumns({"a": lanes(F.col("mark")), "b": lanes(F.col("edited_mark")), "c": lanes(F.col("next_mark"))})
    return marked.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("mark")).alias("fingerprint"),
        as_text(F.col("edited_mark")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"),
    )
