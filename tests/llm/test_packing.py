"""Packing against the tokenizer on whole texts and best-fit decreasing piece by piece."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm import packing, queries

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"


def best_fit(lengths, size):
    """The room left in each bin."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [(room, k) for k, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(size - length)
    return sorted(rooms)


def cut(docs, size):
    """The pieces of every document, from the tokenizer's ids of the whole text."""
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    out = []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]
        for piece, start in enumerate(range(0, len(ids), size)):
            own = ids[start : start + size]
            out.append((doc_id, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return out


def hold(found, docs, size):
    """All pieces are there, sequences have no gaps, and their rooms are those of best-fit decreasing."""
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[c] for c in columns) for r in found), key=repr) == sorted(cut(docs, size), key=repr)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    rooms = []
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= size
        rooms.append(size - end)
    assert sorted(rooms) == best_fit([r.length for r in found], size)


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    hold(queries.op13_best_fit(spark, FOLDER).collect(), [tuple(d) for d in docs], packing.SIZE)


HARD = [
    (1, "Two words, and a no-break space; it's 2024's İstanbul ẞ \x1c x\x85y"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "café ́ alone e ́"),
    (6, "word " * 5000),
    (6, "word " * 5000),
    (7, "z" * 4000 + "é" * 300),
    (8, "<|endoftext|> and <|startoftext|>in"),
    (None, "no id here"),
    (None, None),
] + [(100 + k, "tie here" + " more" * (k % 7)) for k in range(60)]


def test_words_are_those_of_the_tokenizer():
    encoder, tokenizer = packing.ChunkEncoder(packing.TOKENIZER), Tokenizer.from_file(packing.TOKENIZER)
    texts = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x3000), *range(0x10000, 0x10800)]]
    texts += [f"A{c}b1{c}{c}'s {c}x{c}" for c in texts[:0x700]] + ["I'll 've'd 'S don'T 12a3 Ĳsland", " \x1cx\u2003y "]
    found = encoder.encode(texts)
    for text, ids in zip(texts, found):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("parts", [1, 5])
@pytest.mark.parametrize("size", [16, 64])
def test_hard_cases(spark, parts, size):
    names = ("piece", "start", "length", "task", "place", "rank", "n", "before", "ids")
    docs = spark.createDataFrame(HARD, DOCS).withColumns({c: F.lit("x") for c in names}).repartition(parts)
    found = packing.pack(docs, size=size).collect()
    hold(found, HARD, size)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).collect() == []


def test_very_long_text(spark):
    text = "Some words, again and again. " * 400_000
    found = packing.pack(spark.createDataFrame([(1, text)], DOCS), with_ids=False)
    row = found.agg(F.sum("length"), F.countDistinct("sequence_id"), F.max("piece")).first()
    assert row[0] == 7 * 400_000 + 1 and row[1] == row[2] + 1 == -(-row[0] // packing.SIZE)


@settings(max_examples=300, deadline=None)
@given(st.integers(2, 60).flatmap(lambda n: st.tuples(st.just(n), st.lists(st.integers(1, n), max_size=90))))
def test_steps_are_best_fit_decreasing(case):
    size, lengths = case
    counts, rooms = Counter(lengths), Counter()
    steps = packing.best_fit_steps(counts, size).tolist()
    held = defaultdict(int)
    for k, (length, first, bin_, each, offset) in enumerate(steps):
        same = k + 1 < len(steps) and steps[k + 1][0] == length
        for r in range((steps[k + 1][1] if same else counts[length]) - first):
            held[bin_ + r // each] += length
            assert offset + (r % each + 1) * length <= size
    rooms = sorted(size - n for n in held.values())
    assert rooms == best_fit(lengths, size)
    assert len(steps) <= 3 * size * max(1, size.bit_length())
