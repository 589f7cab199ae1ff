"""Word and document vectors of ``documents`` with parameters in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators import skipgram
from marginalia.operators.parts import Dealt, deal
from marginalia.plans.words import _TOKENS_SQL, tokens

SIZE, MIN_COUNT, WINDOW, EPOCHS, NEGATIVES, STEP = 3, 20, 2, 2, 3, 1.0
DIGITS = 6


def _train(documents: DataFrame, dealt: Dealt | None = None) -> DataFrame:
    return skipgram.train(documents, SIZE, MIN_COUNT, WINDOW, EPOCHS, NEGATIVES, STEP, dealt=dealt)


def skipgram_vectors(spark: SparkSession, folder: str) -> DataFrame:
    columns = [F.round(f"{x}_{i}", DIGITS).alias(f"{x}_{i}") for x in "vu" for i in range(SIZE)]
    return _train(tokens(spark, folder)).select("word", *columns)


def skipgram_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = tokens(spark, folder)
    dealt = deal(documents, MIN_COUNT, key="doc_id")
    found = skipgram.document_vectors(documents, _train(documents, dealt), "doc_id", SIZE, dealt=dealt)
    return found.select("doc_id", *(F.round(f"r_{i}", DIGITS).alias(f"r_{i}") for i in range(SIZE)))


QUERIES = {"skipgram_vectors": skipgram_vectors, "skipgram_documents": skipgram_documents}


def _hash_sql(*parts: str) -> str:
    return f"CAST('0x' || substr(md5({' || chr(58) || '.join(parts)}), 1, 8) AS BIGINT)"


def _train_sql() -> str:
    size, one = range(SIZE), 1 << skipgram.GRADIENT_BITS
    bucket = f"CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % {skipgram.NUMBER_BUCKETS}"
    starts = ", ".join(
        f"({_hash_sql('word', repr(str(i)))} / {float(skipgram.HASH_RANGE)!r}::DOUBLE - 0.5) / {SIZE} AS v_{i}, 0.0::DOUBLE AS u_{i}"
        for i in size
    )
    ctes = [
        f"""docs AS (SELECT doc_id, {_TOKENS_SQL} AS t FROM documents),
        counted AS (SELECT unnest(t) AS word FROM docs),
        p0 AS (
            SELECT word, row_number() OVER (ORDER BY {bucket}, word) - 1 AS number, count(*) OVER () AS words, {starts}
            FROM (SELECT word FROM counted GROUP BY word HAVING count(*) >= {MIN_COUNT})),
        near AS ({' UNION ALL '.join(
            f'SELECT unnest(t[:-{d + 1}]) AS a, unnest(t[{d + 1}:]) AS b FROM docs WHERE len(t) > {d}' for d in range(1, WINDOW + 1)
        )}),
        pairs AS (
            SELECT word, context, count(*) AS n
            FROM (SELECT a AS word, b AS context FROM near UNION ALL SELECT b, a FROM near)
            WHERE word IN (SELECT word FROM p0) AND context IN (SELECT word FROM p0) GROUP BY ALL)"""
    ]
    for e in range(EPOCHS):
        score = " + ".join(f"a.v_{i} * b.u_{i}" for i in size)
        drawn = _hash_sql("p.word", f"'{e}'", "CAST(draw AS VARCHAR)")
        ctes.append(
            f"""e{e} AS (
            SELECT word, context, 1.0::DOUBLE AS label, n AS weight FROM pairs
            UNION ALL
            SELECT p.word, o.word, 0.0::DOUBLE, w.weight
            FROM p{e} p, range({NEGATIVES}) r(draw), p{e} o, (SELECT word, sum(n) AS weight FROM pairs GROUP BY word) w
            WHERE o.number = {drawn} % p.words AND w.word = p.word),
        j{e} AS (
            SELECT x.word, x.context, {', '.join(f'a.v_{i}, b.u_{i}' for i in size)}, weight,
                   1.0 / (1.0 + exp(-({score}))) - label AS error,
                   sum(weight) OVER (PARTITION BY x.word) AS total_v, sum(weight) OVER (PARTITION BY x.context) AS total_u
            FROM e{e} x JOIN p{e} a ON a.word = x.word JOIN p{e} b ON b.word = x.context)"""
        )
        for key, own, other in (("word", "v", "u"), ("context", "u", "v")):
            sums = ", ".join(
                f"sum(CAST(floor(weight::DOUBLE / total_{own}::DOUBLE * error * {other}_{i} * {float(one)!r}::DOUBLE + 0.5) AS BIGINT)) AS g_{own}_{i}"
                for i in size
            )
            ctes.append(f"g{own}{e} AS (SELECT {key} AS word, {sums} FROM j{e} GROUP BY 1)")
        moved = ", ".join(
            f"{x}_{i} - {STEP}::DOUBLE * (coalesce(g_{x}_{i}, 0)::DOUBLE / {float(one)!r}::DOUBLE) AS {x}_{i}" for x in "vu" for i in size
        )
        ctes.append(
            f"p{e + 1} AS (SELECT word, number, words, {moved} FROM p{e} LEFT JOIN gv{e} USING (word) LEFT JOIN gu{e} USING (word))"
        )
    return "WITH " + ",\n".join(ctes)


_ROUNDED = ", ".join(f"round({x}_{i}, {DIGITS}) AS {x}_{i}" for x in "vu" for i in range(SIZE))
_MEANS = ", ".join(
    f"round(coalesce(sum(CAST(floor(v_{i} * {float(1 << skipgram.DOCUMENT_BITS)!r}::DOUBLE + 0.5) AS BIGINT)), 0)::DOUBLE"
    f" / {float(1 << skipgram.DOCUMENT_BITS)!r}::DOUBLE / greatest(any_value(len(t)), 1), {DIGITS}) AS r_{i}"
    for i in range(SIZE)
)
ORACLES = {
    "skipgram_vectors": f"{_train_sql()}\nSELECT word, {_ROUNDED} FROM p{EPOCHS}",
    "skipgram_documents": f"""{_train_sql()},
      placed AS (SELECT doc_id, t, unnest(CASE WHEN len(t) = 0 THEN [NULL] ELSE t END) AS word FROM docs)
      SELECT doc_id, {_MEANS} FROM placed LEFT JOIN p{EPOCHS} USING (word) GROUP BY doc_id""",
}
