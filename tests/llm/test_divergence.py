"""The divergence audit against a plain version."""

import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marginalia.llm import divergence
from tests.llm.brute import lower

DOCS = "lang string, source string, text string"
#: Words of letters from hexadecimal digits.
LETTERS = str.maketrans("0123456789", "ghijklmnop")


def audit(rows, min_documents, top):
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        words = re.findall(divergence.TERM, lower(text))
        counts[lang, source].update(words)
        documents[lang].update(set(words))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= min_documents]

        def shares(n):
            return {t: 1 + 10**9 * (n[t] + 2) // (sum(n[k] for k in kept) + 2 * len(kept)) for t in kept}

        def apart(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(o, sum(apart(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, apart(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(found, key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked[:limit])]
    return sorted(out)


def got(df, *numbers):
    return sorted(tuple(r) for r in divergence.audit(df, *numbers).collect())


HARD = (
    [("en", f"s{k % 5}", f"The word-{'ab' * (k % 3)} the É élan e.g. x{k % 4}") for k in range(30)]
    + [("en", "s1", "the-the a.b " * 400), ("en", "s1", "the-the a.b " * 400), ("en", None, None), ("en", "empty", "")]
    + [(None, None, "the the"), (None, "x", "12 34 -- \x1c"), ("", "y", "one term of the two \U0001f600 \U00010400")]
    + [("de", "alone", "nur eine Quelle"), ("fr", "a", "peu"), ("fr", "b", "")]
)


@pytest.mark.parametrize(
    "least, top, parts, block, tile", [(1, 3, 1, 4_000_000, 64), (2, 10, 3, 20, 2), (1, 1, 7, 1, 3)]
)
def test_hard_cases(spark, monkeypatch, least, top, parts, block, tile):
    monkeypatch.setattr(divergence, "BLOCK_PAIRS", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "TERM_BUCKETS", 3)
    names = ("block", "chunk", "docs", "counts", "langs", "sources", "term", "terms", "number", "p", "q", "value", "rank")
    docs = spark.createDataFrame(HARD, DOCS).withColumns({c: F.lit("x") for c in names}).repartition(parts)
    assert got(docs, least, top) == audit(HARD, least, top)


def test_no_rows_and_no_terms(spark):
    docs = spark.createDataFrame(HARD, DOCS)
    assert got(docs.filter("1 = 0")) == []
    assert got(docs, 1000) == audit(HARD, 1000, 10)


def test_very_long_texts(spark):
    rows = [("en", "a", "some words " * 800_000), ("en", "b", "x" * 5_000_000 + "-some"), ("en", "b", "words")]
    docs = spark.createDataFrame(rows, DOCS)
    assert got(docs, 1) == audit(rows, 1, 10)


def test_rare_words_take_no_disk(spark):
    """Words in too few documents are most of a real vocabulary: they are counted, not written."""
    rows = [("en", f"s{k % 3}", "the " + " ".join(f"{k * 7919 + n:08x}".translate(LETTERS) for n in range(200))) for k in range(1000)]
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))

    def written():
        return sum(f.stat().st_size for f in folder.rglob("*.parquet"))

    docs, before = spark.createDataFrame(rows, DOCS), written()
    assert got(docs) == audit(rows, 10, 10)
    assert 20 * (written() - before) < sum(len(text) for _, _, text in rows)


@pytest.mark.parametrize("limit, value", [("BLOCK_DOCUMENTS", 4), ("BLOCK_PAIRS", 20), ("BLOCK_BYTES", 120)])
def test_blocks_of_a_task_add_up(spark, monkeypatch, limit, value):
    monkeypatch.setattr(divergence, limit, value)
    docs = spark.createDataFrame(HARD, DOCS).coalesce(1)
    assert docs.rdd.getNumPartitions() == 1 and divergence.terms_by_block(docs.fillna("")).filter("term = 'the'").count() > 12
    assert got(docs, 2) == audit(HARD, 2, 10)


def test_many_terms_in_a_bucket(spark, monkeypatch):
    """More terms than are compared together, whose rows go on in the next batch."""
    monkeypatch.setattr(divergence, "TERM_BUCKETS", 1)
    monkeypatch.setattr(divergence, "TILE", 2)
    words = [f"{k:05x}".translate(LETTERS) for k in range(9000)]
    rows = [("en", f"s{k}", " ".join(words[k::step] + words[: 40 * k])) for k, step in enumerate((1, 2, 3, 5, 7))]
    assert got(spark.createDataFrame(rows, DOCS), 2) == audit(rows, 2, 10)


@pytest.mark.parametrize("chunks", [[], [b"--"], [b"the", b"--", b"a-b-a", b"-", b"\x1c\xc3\xa9.", b"9"], [b"(x", b"x)"]])
def test_chunks_are_cut_once(chunks):
    terms, numbers, held = divergence._cut(chunks)
    each = [re.findall(divergence.TERM, c.decode()) for c in chunks]
    assert terms.to_pylist() == sorted({t for c in each for t in c})
    assert terms.take(numbers.tolist()).to_pylist() == [t for c in each for t in c] if len(numbers) else not any(each)
    assert held.tolist() == [len(c) for c in each]
