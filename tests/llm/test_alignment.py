"""The alignment against whole texts tokenised by the libraries and links found one by one."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm import alignment, queries
from marginalia.llm.byte_bpe import byte_characters

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"
COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def spans(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends], ends))


def align(docs):
    a = Tokenizer.from_file(alignment.TOKENIZER_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.TOKENIZER_B)
    byte_of = {c: k for k, c in enumerate(byte_characters())}
    rows, links, documents = [], [], Counter()
    for _, text in docs:
        text = text or ""
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        side_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
        side_b = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(ids_b, map(b.id_to_piece, ids_b))
        ]
        if not text or not b"".join(side_a) == b"".join(side_b) == (" " + text).encode():
            rows.append((0, 0, 0, ""))
            links.append(Counter())
            continue
        at_a, at_b = spans(side_a), spans(side_b)
        own, j = Counter(), 0
        for x, (start, end) in zip(ids_a, at_a):
            while at_b[j][1] <= start:
                j += 1
            k = j
            while k < len(at_b) and at_b[k][0] < end:
                own[x, ids_b[k]] += 1
                k += 1
        ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups = [
            "|".join(
                ",".join(str(i) for i, (_, e) in zip(ids, at) if start < e <= end)
                for ids, at in ((ids_a, at_a), (ids_b, at_b))
            )
            for start, end in zip([0, *ends], ends)
        ] if len(text) < 2000 else None
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else None
        rows.append((len(ids_a), len(ids_b), len(ends), digest))
        links.append(own)
        documents.update(own.keys())
    best = defaultdict(int)
    for (x, _), n in documents.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), (n_a, n_b, n_groups, digest), own in zip(docs, rows, links):
        n_best = sum(n for p, n in own.items() if documents[p] == best[p[0]])
        count_sum = sum(n * documents[p] for p, n in own.items())
        out.append((doc_id, n_a, n_b, n_groups, sum(own.values()), n_best, count_sum, digest))
    return out, documents


def same(got, expected):
    """Equal rows; digests where the plain version has one."""
    assert len(got) == len(expected)
    for g, e in zip(sorted(got, key=lambda r: repr(r[:7])), sorted(expected, key=lambda r: repr(r[:7]))):
        assert g[:7] == e[:7] and e[7] in (None, g[7])


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    same([tuple(r) for r in queries.op11_alignment(spark, FOLDER).select(*COLUMNS).collect()], align(docs)[0])


HARD = [
    (1, "Words and  two spaces,\n new\n\n lines \t tabs   \n end "),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "   leading"),
    (6, "a ▁ b and ▁c"),
    (7, "<s> </s> <unk> <|endoftext|> <0x41> control \x00\x1c \x85x  y ᠎z"),
    (8, "ﬁ Ａ é é \U0001f600\U0001f600 日本語 текст ñandú"),
    (9, "the the the " * 300),
    (9, "the the the " * 300),
    (10, "x" * 3000 + " " * 50 + "é" * 500),
    (None, "no id"),
    (None, None),
    (11, "a b  c d  e"),
] + [(100 + k, f"tied {k % 3} words {'here ' * (k % 4)}") for k in range(30)]


@pytest.mark.parametrize("parts, radixes, records, fan_in", [(1, 256, 4_000_000, 256), (3, 4, 50, 2), (5, 1, 1, 3)])
def test_hard_cases(spark, monkeypatch, parts, radixes, records, fan_in):
    monkeypatch.setattr(alignment, "BLOCK_RECORDS", records)
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    monkeypatch.setattr(alignment, "FAN_IN", fan_in)
    names = ("block", "radix", "pairs", "held", "records", "answer", "n_a", "n_best")
    docs = spark.createDataFrame(HARD, DOCS).withColumns({c: F.lit("x") for c in names}).repartition(parts)
    rows, pairs = alignment.align(docs, radixes=radixes)
    expected, documents = align(HARD)
    same([tuple(r) for r in rows.select(*COLUMNS).collect()], expected)
    found = pairs.collect()
    assert {(r.id_a, r.id_b): r.documents for r in found} == dict(documents) and len(found) == len(documents)
    highest = {a: max(n for (x, _), n in documents.items() if x == a) for a, _ in documents}
    assert all(r.best == (r.documents == highest[r.id_a]) for r in found)


def test_words_are_those_of_the_tokenizer():
    v = alignment.Vocabularies(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    chunks = [chr(c) for c in [*range(0x21, 0x400)]]
    chunks += [f"A{c}b1{c}{c}'s{c}x{c}" for c in chunks] + ["'s", "I'll've'd'S", "'12a3''t", "x" * 300]
    for chunk, ids in zip(chunks, v.tokens(chunks)[0]):
        assert np.frombuffer(ids, np.uint16).tolist() == v.a.encode(" " + chunk, add_special_tokens=False).ids, repr(chunk)


def test_empty_table(spark):
    rows, pairs = alignment.align(spark.createDataFrame([], DOCS))
    assert rows.columns == COLUMNS and rows.collect() == [] and pairs.collect() == []


def test_very_long_text(spark):
    docs = [(1, "Some words, again and again. " * 100_000), (2, "Some words")]
    expected = align(docs)[0]
    same([tuple(r) for r in alignment.align(spark.createDataFrame(docs, DOCS))[0].select(*COLUMNS).collect()], expected)


def test_packing_round_trip():
    for values in ([], [0], [1, 255, 256, 1 << 40], list(range(1000))):
        assert [a.tolist() for a in alignment.unpack(alignment.pack(np.array(values, np.int64), np.array([7])))] == [values, [7]]
