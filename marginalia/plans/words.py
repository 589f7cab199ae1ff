"""Tokens, vocabulary, word and document vectors, and position tags over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.text import space_tokens
from marginalia.operators import tagging, viterbi
from marginalia.operators import word_vectors as wv
from marginalia.operators.parts import deal
from marginalia.operators.staging import staged, staged_path
from marginalia.sources.corpora import read_tagged_corpus
from marginalia.sources.tables import read_table, spread

MIN_COUNT = 5


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, text array<string>)``."""
    documents = spread(read_table(spark, folder, "documents", "doc_id", "text"), "doc_id")
    return documents.select("doc_id", space_tokens(F.col("text")).alias("text"))


def sentences(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document as a tagged sentence; its words are what spaces separate."""
    documents = spread(read_table(spark, folder, "documents", "doc_id", "text"), "doc_id")
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    chars, tags = tagging.encode(F.split("line", " "))
    return lines.select(F.struct("doc_id", "line_no").alias("sent_id"), chars, tags)


def tokens_count(spark: SparkSession, folder: str) -> DataFrame:
    return tokens(spark, folder).select("doc_id", F.size("text").alias("n_tokens"))


def w2v_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return wv.vocabulary(tokens(spark, folder), MIN_COUNT)


def doc_vectors(spark: SparkSession, folder: str) -> DataFrame:
    documents = tokens(spark, folder)
    dealt = deal(documents, key="doc_id")
    model = wv.fit_word_vectors(documents, dealt=dealt)
    return wv.document_vectors(model, documents, dealt=dealt).select("doc_id", "result")


def word_vector_table(spark: SparkSession, folder: str) -> DataFrame:
    return wv.word_vectors(wv.fit_word_vectors(tokens(spark, folder), min_count=MIN_COUNT))


def bmes_tag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tagging.tag_counts(sentences(spark, folder))


def bmes_starts(spark: SparkSession, folder: str) -> DataFrame:
    return tagging.start_counts(sentences(spark, folder))


def bmes_transitions(spark: SparkSession, folder: str) -> DataFrame:
    return tagging.transition_counts(sentences(spark, folder))


def bmes_emissions(spark: SparkSession, folder: str) -> DataFrame:
    return tagging.emission_counts(sentences(spark, folder))


def bmes_words(spark: SparkSession, folder: str) -> DataFrame:
    words = tagging.words_of(sentences(spark, folder))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def aligned_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """All sentences written to two sets of text files, read back line by line and counted again."""
    rows = staged(sentences(spark, folder).select("chars", "tags"))
    paths = {c: staged_path(spark, f"lines-{c}") for c in rows.columns}
    for column, path in paths.items():
        rows.select(column).write.text(path)
    return tagging.tag_counts(read_tagged_corpus(spark, paths["chars"], paths["tags"]))


def _training_lines(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The lines of three documents of four with their tags, and those of the fourth."""
    rows = staged(sentences(spark, folder))
    key = F.pmod("sent_id.doc_id", F.lit(4))
    return rows.filter(key < 3), rows.filter(key == 3)


def bmes_model(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of first tags, pairs of tags and characters, from three documents of four."""
    return viterbi.model_table(spark, viterbi.fit(_training_lines(spark, folder)[0]))


def bmes_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    """The score of the tags found for every line of the other documents."""
    train, test = _training_lines(spark, folder)
    return viterbi.tag(test, viterbi.fit(train)).select("sent_id.doc_id", "sent_id.line_no", "score")


def bmes_viterbi_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """How often each tag was found where each stands."""
    train, test = _training_lines(spark, folder)
    given = test.select("chars", F.col("tags").alias("given"))
    found = viterbi.tag(given, viterbi.fit(train))
    pairs = F.arrays_zip(tagging.characters(F.col("given")).alias("tag"), tagging.characters(F.col("tags")).alias("found"))
    cells = found.select(F.explode_outer(pairs).alias("p")).filter("p is not null")
    return cells.groupBy("p.tag", "p.found").agg(F.count("*").alias("n"))


QUERIES = {
    "bmes_model": bmes_model,
    "bmes_viterbi": bmes_viterbi,
    "bmes_viterbi_confusion": bmes_viterbi_confusion,
    "tokens_count": tokens_count,
    "w2v_vocabulary": w2v_vocabulary,
    "doc_vectors": doc_vectors,
    "word_vectors": word_vector_table,
    "bmes_tag_counts": bmes_tag_counts,
    "bmes_starts": bmes_starts,
    "bmes_transitions": bmes_transitions,
    "bmes_emissions": bmes_emissions,
    "bmes_words": bmes_words,
    "aligned_corpus": aligned_corpus,
}

_TOKENS_SQL = """CASE WHEN text <> '' AND rtrim(text, ' ') = '' THEN CAST([] AS VARCHAR[])
  ELSE string_split(rtrim(text, ' '), ' ') END"""
# ``unnest`` keeps the order of a list, which gives words their place in the line
_WORDS_SQL = """lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents
),
pieces AS (
  SELECT doc_id, line_no, list_filter(string_split(line, ' '), lambda w: w <> '') AS ws FROM lines
),
words AS (
  SELECT doc_id, line_no, unnest(ws) AS word, unnest(range(len(ws))) AS word_no FROM pieces
),
sized AS (SELECT *, length(word) AS size FROM words)"""

ORACLES = {
    "tokens_count": f"SELECT doc_id, CAST(len({_TOKENS_SQL}) AS INTEGER) AS n_tokens FROM documents",
    "w2v_vocabulary": f"""SELECT word, count(*) AS n FROM (SELECT unnest({_TOKENS_SQL}) AS word FROM documents)
      GROUP BY word HAVING count(*) >= {MIN_COUNT}""",
    "bmes_tag_counts": f"""WITH {_WORDS_SQL},
      counts AS (
        SELECT 'S' AS tag, count(*) FILTER (WHERE size = 1) AS n FROM sized
        UNION ALL SELECT 'B', count(*) FILTER (WHERE size > 1) FROM sized
        UNION ALL SELECT 'E', count(*) FILTER (WHERE size > 1) FROM sized
        UNION ALL SELECT 'M', CAST(coalesce(sum(size - 2) FILTER (WHERE size > 2), 0) AS BIGINT) FROM sized
      )
      SELECT tag, n FROM counts WHERE n > 0""",
    "bmes_starts": f"""WITH {_WORDS_SQL}
      SELECT CASE WHEN size = 1 THEN 'S' ELSE 'B' END AS tag, count(*) AS n FROM sized WHERE word_no = 0 GROUP BY 1""",
    "bmes_transitions": f"""WITH {_WORDS_SQL},
      between AS (
        SELECT CASE WHEN lag(size) OVER line = 1 THEN 'S' ELSE 'E' END AS tag,
               CASE WHEN size = 1 THEN 'S' ELSE 'B' END AS next_tag, lag(size) OVER line AS before
        FROM sized WINDOW line AS (PARTITION BY doc_id, line_no ORDER BY word_no)
      ),
      counts AS (
        SELECT 'BE' AS pair, count(*) AS n FROM sized WHERE size = 2
        UNION ALL SELECT 'BM', count(*) FROM sized WHERE size > 2
        UNION ALL SELECT 'ME', count(*) FROM sized WHERE size > 2
        UNION ALL SELECT 'MM', CAST(coalesce(sum(size - 3), 0) AS BIGINT) FROM sized WHERE size > 3
        UNION ALL SELECT tag || next_tag, count(*) FROM between WHERE before IS NOT NULL GROUP BY 1
      )
      SELECT pair, n FROM counts WHERE n > 0""",
    "bmes_emissions": f"""WITH {_WORDS_SQL},
      places AS (SELECT word, size, unnest(range(1, size + 1)) AS place FROM sized)
      SELECT CASE WHEN size = 1 THEN 'S' WHEN place = 1 THEN 'B' WHEN place = size THEN 'E' ELSE 'M' END AS tag,
             substring(word, place, 1) AS ch, count(*) AS n
      FROM places GROUP BY 1, 2""",
    "bmes_words": f"WITH {_WORDS_SQL} SELECT word, count(*) AS n FROM words GROUP BY word",
}
ORACLES["aligned_corpus"] = ORACLES["bmes_tag_counts"]


#: Segments of a line are joined in pairs this often, so lines of up to 2 ** LEVELS characters come to one segment.
LEVELS = 24
_MODEL_SQL = f"""{_WORDS_SQL.replace("FROM documents", "FROM documents WHERE doc_id % 4 < 3")},
places AS (SELECT word, size, doc_id, line_no, word_no, unnest(range(1, size + 1)) AS place FROM sized),
spelt AS MATERIALIZED (
  SELECT CASE WHEN size = 1 THEN 'S' WHEN place = 1 THEN 'B' WHEN place = size THEN 'E' ELSE 'M' END AS tag, substring(word, place, 1) AS ch,
         row_number() OVER (PARTITION BY doc_id, line_no ORDER BY word_no, place) AS pos, doc_id, line_no
  FROM places),
followed AS (SELECT tag, lead(tag) OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS next FROM spelt),
allowed(tag, next) AS (VALUES {", ".join(f"('{p[0]}', '{p[1]}')" for p in tagging.TRANSITIONS)}),
starts AS MATERIALIZED (
  SELECT tag, ln((count(doc_id) + 1.0) / (sum(count(doc_id)) OVER () + 2)) AS v
  FROM (VALUES ('B'), ('S')) t(tag) LEFT JOIN (SELECT * FROM spelt WHERE pos = 1) USING (tag) GROUP BY tag),
follows AS MATERIALIZED (
  SELECT a.tag, a.next, ln((count(f.tag) + 1.0) / (sum(count(f.tag)) OVER (PARTITION BY a.tag) + 2)) AS v
  FROM allowed a LEFT JOIN followed f ON f.tag = a.tag AND f.next = a.next GROUP BY a.tag, a.next),
letters AS (SELECT DISTINCT ch FROM spelt UNION ALL SELECT ''),
tags AS (SELECT tag, count(doc_id) + (SELECT count(*) FROM letters) AS whole
  FROM (VALUES ('B'), ('M'), ('E'), ('S')) t(tag) LEFT JOIN spelt USING (tag) GROUP BY tag),
emits AS MATERIALIZED (
  SELECT tag, ch, ln((coalesce(n, 0) + 1.0) / any_value(whole)) AS v
  FROM tags CROSS JOIN letters LEFT JOIN (SELECT tag, ch, count(*) AS n FROM spelt GROUP BY tag, ch) USING (tag, ch) GROUP BY tag, ch, n),
model AS MATERIALIZED (
  SELECT kind, tag, key, CAST(floor({viterbi.UNIT} * v + 0.5) AS BIGINT) AS score FROM (
    SELECT 'start' AS kind, tag, '' AS key, v FROM starts UNION ALL SELECT 'follow', tag, next, v FROM follows
    UNION ALL SELECT 'emit', tag, ch, v FROM emits))"""


def _viterbi_sql() -> str:
    """``gK``: by segment of 2 ** K characters, its first and its last tag, the best score of the tags between them."""
    ctes = [
        f"""own AS (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
          FROM documents WHERE doc_id % 4 = 3),
        own_words AS (
          SELECT doc_id, line_no, unnest(ws) AS word, unnest(range(len(ws))) AS word_no
          FROM (SELECT doc_id, line_no, list_filter(string_split(line, ' '), lambda w: w <> '') AS ws FROM own)),
        own_places AS (SELECT *, unnest(range(1, length(word) + 1)) AS place FROM own_words),
        own_chars AS (
          SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY word_no, place) - 1 AS seg,
                 substring(word, place, 1) AS ch FROM own_places),
        emit AS MATERIALIZED (SELECT tag, key, score FROM model WHERE kind = 'emit'),
        follow AS MATERIALIZED (SELECT tag, key, score FROM model WHERE kind = 'follow'),
        g0 AS MATERIALIZED (
          SELECT doc_id, line_no, seg, e.tag AS a, e.tag AS b, e.score AS v
          FROM (SELECT c.* EXCLUDE (ch), coalesce(l.key, '') AS key FROM own_chars c LEFT JOIN (SELECT DISTINCT key FROM emit) l ON l.key = c.ch)
          JOIN emit e USING (key))"""
    ]
    for k in range(LEVELS):
        ctes.append(
            f"""m{k} AS (SELECT doc_id, line_no, max(seg) AS last FROM g{k} GROUP BY ALL),
        g{k + 1} AS MATERIALIZED (
          SELECT l.doc_id, l.line_no, l.seg // 2 AS seg, l.a, r.b, max(l.v + t.score + r.v) AS v
          FROM g{k} l JOIN follow t ON t.tag = l.b
          JOIN g{k} r ON r.doc_id = l.doc_id AND r.line_no = l.line_no AND r.seg = l.seg + 1 AND r.a = t.key
          WHERE l.seg % 2 = 0 GROUP BY ALL
          UNION ALL
          SELECT doc_id, line_no, seg // 2, a, b, v FROM g{k} JOIN m{k} USING (doc_id, line_no) WHERE seg % 2 = 0 AND seg = last)"""
        )
    ctes.append(
        f"""whole AS (
          SELECT doc_id, line_no, max(v + s.score) AS score FROM g{LEVELS} JOIN model s ON s.kind = 'start' AND s.tag = a
          WHERE b IN ('E', 'S') GROUP BY ALL)"""
    )
    return ",\n".join(ctes)


ORACLES["bmes_model"] = f"WITH {_MODEL_SQL} SELECT kind, tag, key, score FROM model"
ORACLES["bmes_viterbi"] = f"""WITH {_MODEL_SQL}, {_viterbi_sql()}
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(coalesce(score, 0) AS BIGINT) AS score FROM own LEFT JOIN whole USING (doc_id, line_no)"""
