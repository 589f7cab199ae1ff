"""The registered queries of these operators, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import (
    alignment,
    byte_bpe,
    chat,
    decontaminate,
    divergence,
    homomorphic,
    licences,
    packing,
    pii,
    quality,
    repeats,
    simhash,
    warc,
)
from marginalia.llm.common import LOWER, NO_WORD, UPPER
from marginalia.sources.tables import read_table


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents", "doc_id", "text")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_documents(spark, folder))


def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan_licences(_documents(spark, folder)).drop("spans")


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return homomorphic.compare_edited(_documents(spark, folder))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, folder))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(read_table(spark, folder, "pages", "page_id", "url", "html"))


SAYS = "\\### Assistant: </turn> ok"


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    given = read_table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(SAYS).alias("text"),
    )
    turns = given.unionByName(own).withColumn("parts", chat.text_part(F.col("text")))
    made = chat.format_chat(turns)
    read = made.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"),
        F.size("attachments").cast("bigint").alias("n_attachments"),
        "n_expanded",
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "n_attachments",
        "n_expanded",
    )


def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(_documents(spark, folder)).drop("kept")


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encode_texts(_documents(spark, folder), with_ids=False)


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "benchmark", "item_id", "text")
    return decontaminate.find_items(_documents(spark, folder), items).drop("item_ids", "th")


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.personal_data(_documents(spark, folder)))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(_documents(spark, folder))[0]


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read_table(spark, folder, "documents", "lang", "source", "text"))


def op13_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_documents(spark, folder), with_ids=False)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_licences, op3_fingerprints, op4_simhash, op5_warc, op6_chat, op7_repeats, op8_byte_bpe,
        op9_decontaminate, op10_personal_data, op11_alignment, op12_divergence, op13_best_fit,
    )
}

_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '{no_word}'), lambda x: x <> '')".format(
    upper=UPPER, lower=LOWER, no_word=NO_WORD
)

ORACLES: dict[str, str] = {
    "op9_decontaminate": f"""
        WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT item, list_slice(w, pos, pos + least(13, len(w)) - 1) AS words
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS pos FROM items WHERE len(w) > 0)),
        d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        sizes AS (SELECT DISTINCT len(words) AS n FROM windows),
        places AS (
            SELECT doc_id, pos, n, list_slice(w, pos, pos + n - 1) AS words
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, sizes WHERE len(w) >= n)),
        found AS (SELECT doc_id, pos, n, item FROM places JOIN windows USING (words)),
        hits AS (
            SELECT doc_id, count(*) AS n_hit
            FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS word FROM found) GROUP BY doc_id),
        held AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN held USING (doc_id)
    """,
    "op12_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
        t AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '{term}')) AS term FROM d),
        kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= 10),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (
            SELECT lang, source, coalesce(v, 0)::HUGEINT AS v, coalesce(total, 0)::HUGEINT AS total
            FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
            LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
        w AS (SELECT lang, sum(total) AS total FROM g GROUP BY lang),
        p AS (
            SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 2) // (total + 2 * v) AS p
            FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
        q AS (
            SELECT lang, term, 1 + 1000000000 * (sum(n) + 2) // (any_value(w.total) + 2 * any_value(v)) AS q
            FROM c JOIN w USING (lang) JOIN v USING (lang) GROUP BY lang, term),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item,
                   coalesce(s.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
                FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
                ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
        terms AS (
            SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
            FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term' AS part, item, value FROM terms)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM ranked QUALIFY part = 'pair' OR rank <= 10
    """.format(upper=UPPER, lower=LOWER, term=divergence.TERM),
}
