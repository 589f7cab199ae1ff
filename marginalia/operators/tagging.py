"""Sentences tagged by character position in a word: B(egin), M(iddle), E(nd), S(ingle).

Tables are ``(sent_id, chars string, tags string)``, one character of ``tags`` per character of
``chars``. A sentence is one row, so what happens within one needs no shuffle. Arrays are unfolded
with the outer forms of explode: the plain ones make Spark work an array out twice, once to skip
empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAGS = ["B", "M", "E", "S"]
# The pairs that may follow each other in a well-formed tag string (S | B M* E)*.
TRANSITIONS = ["BE", "BM", "MM", "ME", "EB", "ES", "SB", "SS"]
# Where a tag string is not well formed: a foreign character, a bad first or last tag, a bad pair.
MALFORMED = "[^BMES]|^[ME]|[BM]$|[BM][BS]|[ES][ME]"


def characters(text: Column) -> Column:
    """The characters of a string as an array; none for the empty string."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def encode(words: Column) -> tuple[Column, Column]:
    """``(chars, tags)`` of an array of words; empty words have no characters and no tags."""
    length = F.char_length
    tag = lambda w: (
        F.when(length(w) == 0, F.lit(""))
        .when(length(w) == 1, F.lit("S"))
        .otherwise(F.concat(F.lit("B"), F.repeat(F.lit("M"), length(w) - 2), F.lit("E")))
    )
    return F.array_join(words, "").alias("chars"), F.array_join(F.transform(words, tag), "").alias("tags")


def well_formed(tags: Column) -> Column:
    return ~tags.rlike(MALFORMED)


def tagged_characters(sentences: DataFrame) -> DataFrame:
    """``(sent_id, pos, ch, tag)``, positions from 0."""
    pairs = F.arrays_zip(
        characters(F.col("chars")).alias("ch"), characters(_checked_tags()).alias("tag")
    )
    exploded = sentences.select("sent_id", F.posexplode_outer(pairs).alias("pos", "pair"))
    return exploded.filter("pos is not null").select("sent_id", "pos", "pair.ch", "pair.tag")


def words_of(sentences: DataFrame) -> DataFrame:
    """``(sent_id, word)``, one row per word the tags spell out."""
    words = decode(sentences).select("sent_id", F.explode_outer("words").alias("word"))
    return words.filter("word is not null")


def decode(sentences: DataFrame) -> DataFrame:
    """Add ``words``, the words the tags spell out."""
    ended = F.zip_with(
        characters(F.col("chars")),
        characters(_checked_tags()),
        lambda ch, tag: F.when(tag.isin("E", "S"), F.concat(ch, F.lit("\n"))).otherwise(ch),
    )  # a line of text has no line break of its own
    words = F.filter(F.split(F.array_join(ended, ""), "\n"), lambda w: w != "")
    one_line = F.when(F.instr("chars", "\n") == 0, words).otherwise(
        F.raise_error(F.lit("a sentence must be one line")).cast("array<string>")
    )
    return sentences.withColumn("words", one_line)


def tag_counts(sentences: DataFrame) -> DataFrame:
    """``(tag, n)`` for every tag that occurs."""
    counts = [_shrinks_by(F.replace("tags", F.lit(t), F.lit(""))) for t in TAGS]
    return _as_rows(sentences, "tag", TAGS, counts)


def start_counts(sentences: DataFrame) -> DataFrame:
    """``(tag, n)`` over the first tags of all sentences."""
    first = F.substring("tags", 1, 1)
    counts = [F.when(first == t, 1).otherwise(0) for t in TAGS]
    return _as_rows(sentences, "tag", TAGS, counts)


def transition_counts(sentences: DataFrame) -> DataFrame:
    """``(pair, n)``: how often a tag follows another within a sentence."""
    counts = [_shrinks_by(F.regexp_replace("tags", f"{p[0]}(?={p[1]})", "")) for p in TRANSITIONS]
    return _as_rows(sentences, "pair", TRANSITIONS, counts)


def _shrinks_by(shortened: Column) -> Column:
    """How many tags were taken out."""
    return F.char_length("tags") - F.char_length(shortened)


def emission_counts(sentences: DataFrame) -> DataFrame:
    """``(tag, ch, n)``: how often a tag stands at a character."""
    return tagged_characters(sentences).groupBy("tag", "ch").agg(F.count("*").alias("n"))


def _as_rows(sentences: DataFrame, name: str, keys: list[str], counts: list[Column]) -> DataFrame:
    """Sums of all counts in one aggregate, turned into one row per key that occurs."""
    checked = sentences.select(_checked_tags().alias("tags"))
    sums = [F.sum(n).cast("bigint") for n in counts]
    pairs = F.array(*[F.struct(F.lit(k).alias(name), n.alias("n")) for k, n in zip(keys, sums)])
    rows = checked.agg(pairs.alias("pairs")).select(F.inline("pairs"))
    return rows.filter(F.col("n") > 0)


def _checked_tags() -> Column:
    tags = F.col("tags")
    good = well_formed(tags) & (F.char_length(tags) == F.char_length("chars"))
    return F.when(F.coalesce(good, F.lit(False)), tags).otherwise(
        F.raise_error(F.lit("tags must be (S|BM*E)* and as long as the sentence")).cast("string")
    )
