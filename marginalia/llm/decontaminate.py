"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window is ``size`` consecutive words of an item, or all words of a shorter one. Words are ordered by how
often they occur in the documents; a document that holds a window holds its rarest word, so that one word
is the prefix that must be joined. A document word that is such a prefix proposes a place for each of its windows; it must
lie within the document (length and positional bounds). Proposed places are verified word by word.

Documents are read three times: for word counts, for prefix places, for verification. Only prefix places are shuffled
beside the documents, keyed by id and text hash, so repeated rows are one key. The tables joined to
document words hold words of the items only; Spark broadcasts them when small enough, and shuffles otherwise.

Null texts have no words; items without words have no windows; a document or item may be of any length.
Repeated items count once by item id. Null ids are kept for documents and left out of item lists. Empty
tables on either side give no hits. Only the named columns are read. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import id_and_text, text_key, word_array
from marginalia.operators.staging import staged

SIZE = 13
#: A text is contaminated when at least one of this many of its words is hit.
ONE_IN = 20


def item_windows(items: DataFrame, size: int = SIZE) -> DataFrame:
    """``(words, item_ids)``: every distinct window of ``items(item_id, text)`` and the items that have it."""
    own = items.select("item_id", word_array(F.col("text")).alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(size - 1), F.lit(1)))
    windows = own.select("item_id", "w", F.explode(starts).alias("at")).select(
        "item_id", F.slice("w", F.col("at"), F.lit(size)).alias("words")
    )
    return windows.groupBy("words").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))


def prefixes(windows: DataFrame, documents: DataFrame) -> DataFrame:
    """``windows`` with their rarest word over all documents, its first place and the words beside it:
    ``(word, off, words, item_ids, l_before, l_after)``."""
    parts = windows.select("words", "item_ids", F.posexplode("words").alias("off", "word"))
    wanted = staged(parts.select("word").distinct())
    counts = documents.select(F.explode("w").alias("word")).join(wanted, "word").groupBy("word").count()
    counted = parts.join(counts, "word", "left").withColumn("n", F.coalesce("count", F.lit(0)))
    order = Window.partitionBy("words").orderBy("n", "word", "off")
    rarest = counted.withColumn("rank", F.row_number().over(order)).filter("rank = 1")
    # A word that no document holds leads nowhere.
    at = F.col("off")
    before, after = F.when(at > 0, F.get("words", at - F.lit(1))), F.get("words", at + F.lit(1))
    return rarest.filter("n > 0").select("word", "off", "words", "item_ids", before.alias("l_before"), after.alias("l_after"))


def find_items(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with what it shares with ``items(item_id, text)``.

    ``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids, th)``; ``th`` is the text hash.
    """
    own = id_and_text(docs).select(
        F.col("doc_id"), text_key(F.col("text")).alias("th"), word_array(F.col("text")).alias("w")
    )
    lead = staged(prefixes(item_windows(items, size), own))
    beside = F.transform(
        "w",
        lambda x, i: F.struct(
            x.alias("word"), F.when(i > 0, F.get("w", i - F.lit(1))).alias("before"), F.get("w", i + F.lit(1)).alias("after")
        ),
    )
    at = own.select("doc_id", "th", F.size("w").alias("n"), F.posexplode(beside).alias("pos", "x"))
    at = at.select("doc_id", "th", "n", "pos", "x.*")
    words = staged(lead.select("word").distinct())
    held = at.join(words, "word")
    # The words beside the prefix must be those of the window as well: nearly all that is left is true.
    places = (
        held.join(lead, "word")
        .filter("(l_before is null or l_before = before) and (l_after is null or l_after = after)")
        .select("doc_id", "th", "n", (F.col("pos") - F.col("off")).alias("start"), "words", "item_ids")
        .filter("start >= 0 and start + size(words) <= n")
    )
    place = F.struct("start", "words", "item_ids")
    proposed = staged(
        places.groupBy("doc_id", "th").agg(F.collect_set(place).alias("places"))
        .select(F.col("doc_id").alias("p_id"), F.col("th").alias("p_th"), "places")
    )
    # Texts are smaller to move than their words, so they are cut again behind the join.
    texts = id_and_text(docs).withColumn("th", text_key(F.col("text")))
    met = texts.join(proposed, texts["doc_id"].eqNullSafe(proposed["p_id"]) & (texts["th"] == proposed["p_th"]), "left")
    joined = met.select("doc_id", "th", word_array(F.col("text")).alias("w"), "places")
    none = F.array().cast("array<struct<start: int, words: array<string>, item_ids: array<string>>>")
    true = F.filter(
        F.coalesce("places", none),
        lambda p: F.slice("w", p["start"] + F.lit(1), F.size(p["words"])) == p["words"],
    )
    hit = F.array_distinct(
        F.flatten(F.transform("found", lambda p: F.sequence(p["start"], p["start"] + F.size(p["words"]) - F.lit(1))))
    )
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda p: p["item_ids"]))))
    return (
        joined.select("doc_id", "th", F.size("w").cast("bigint").alias("n_words"), true.alias("found"))
        .select("doc_id", "th", "n_words", F.size(hit).cast("bigint").alias("n_hit"), ids.alias("item_ids"))
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("item_ids").cast("bigint").alias("n_items"),
            F.sha2(F.encode(F.array_join("item_ids", ","), "UTF-8"), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words"))).alias("contaminated"),
            "item_ids",
            "th",
        )
    )
