"""The operators against plain versions on the given tables, and on small hard cases."""

import random
import time

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from marginalia.llm import (
    byte_bpe,
    chat,
    decontaminate,
    homomorphic,
    licences,
    pii,
    quality,
    queries,
    repeats,
    simhash,
    warc,
)
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"

LONG = "Some words stand here again and again, and no one minds. " * 40
HARD = [
    (1, "plain text with cc by and CC-BY, under the MIT License."),
    (2, None),
    (3, ""),
    (4, "plain text with cc by and CC-BY, under the MIT License."),
    (4, "plain text with cc by and CC-BY, under the MIT License."),
    (5, LONG),
    (6, "x" * 5000 + "é" * 300),
    (7, "mail a.b@c.example.org or +1 (234) 555-6789, 10.0.0.255, 4539 1488 0343 6467 \n\n two  blanks"),
    (8, LONG[7:900] + " other end"),
    (None, "a row without an id, " + LONG),
    (None, None),
]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def table(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select(*columns).collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(table(spark, "documents", "doc_id", "text"))


@pytest.fixture(scope="module")
def hard(spark):
    """Rows with nulls, repeats and long texts, and columns whose names operators use themselves."""
    return spark.createDataFrame(HARD, DOCS).withColumns(
        {c: F.lit(None).cast("string") for c in ("th", "fp", "w", "n", "tag", "spans", "word", "bucket", "lang", "found")}
    )


@pytest.fixture(scope="module")
def empty(hard):
    return hard.filter("1 = 0")


NAMED = [r for r in HARD if r[0] is not None]


def test_licences(spark, docs, hard, empty):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    got = rows(queries.op2_licences(spark, FOLDER), *columns)
    assert got == sorted(brute.phrases(docs, licences.BASE), key=repr)
    assert rows(licences.scan_licences(hard), *columns) == sorted(brute.phrases(HARD, licences.BASE), key=repr)
    assert licences.scan_licences(empty).count() == 0


def test_licence_spans_chain_over_small_changes(spark):
    wording = licences.WORDINGS["bsd"][0].split()
    text = "intro " + " ".join(wording[:9] + ["changed"] + wording[10:]) + " outro"
    row = licences.scan_licences(spark.createDataFrame([(1, text)], DOCS)).first()
    assert row.labels == "bsd" and row.base_labels == "" and 0.9 < row.score < 1
    assert [(s.label, s.start, s.end) for s in row.spans] == [("bsd", 1, 1 + len(wording))]


def test_automaton_finds_overlapping_places():
    base = {"a b a": "x", "b a": "y", "a": "z"}
    words = [w.encode() for w in "a b a b a c b a".split()]
    hits, _ = licences.Automaton(base, {}).matches(words, 2)
    expected = [
        (k, p) for p, phrase in enumerate(base) for k in range(len(words))
        if words[k : k + len(phrase.split())] == [w.encode() for w in phrase.split()]
    ]
    assert sorted(hits) == sorted(expected)


def test_fingerprints(spark, docs, hard, empty):
    out = queries.op3_fingerprints(spark, FOLDER).cache()
    assert rows(out, "doc_id", "n_chars", "edited_sha256") == sorted(brute.edited(docs), key=repr)
    near = out.agg(F.avg("near_edited"), F.avg("near_next"), F.min("near_next"), F.max("near_edited")).first()
    assert near[0] > 0.35 and near[1] < 0.15 and near[2] >= 0 and near[3] <= 1
    texts = dict(docs)
    by_text = {}
    for r in out.collect():
        assert by_text.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len(by_text)
    named = homomorphic.compare_edited(hard.filter("doc_id is not null"))
    assert rows(named, "doc_id", "n_chars", "edited_sha256") == sorted(brute.edited(NAMED), key=repr)
    assert homomorphic.compare_edited(hard).count() == len(HARD)
    assert homomorphic.compare_edited(empty).count() == 0


def test_fingerprints_add_up_in_slices(spark, monkeypatch):
    texts = [(k, " ".join(f"part {k * j}," for j in range(n))) for k, n in enumerate([0, 1, 2, 3, 4, 7, 300])] + [(9, None)]
    df = spark.createDataFrame(texts, DOCS)
    whole = [r.f for r in df.select(homomorphic.fingerprint(F.col("text")).alias("f")).collect()]
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(homomorphic, "SLICE", size)
        assert [r.f for r in df.select(homomorphic.fingerprint(F.col("text")).alias("f")).collect()] == whole
    wide = [((1 << 32) - 1) << 32 | (1 << 32) - 2, 3 << 32 | 5]
    row = spark.createDataFrame([(wide[0] - (1 << 64), wide[1])], "a bigint, b bigint")
    assert row.select(homomorphic._add_packed(F.col("a"), F.col("b"))).first()[0] == 2 << 32 | 3


def test_fingerprint_of_many_parts(spark):
    df = spark.createDataFrame([("a\n" * 150_000, "a")], "many string, one string")
    found = df.select(*(homomorphic.lanes(homomorphic.fingerprint(F.col(c))).alias(c) for c in df.columns)).first()
    assert found.many == [v * 150_000 % (1 << 32) for v in found.one]


def test_fingerprint_is_a_multiset_hash(spark):
    texts = [("one.\ntwo.\nthree.", "three.\none.\ntwo.", "two.", "one.\nthree.")]
    df = spark.createDataFrame(texts, "a string, b string, c string, d string")
    f = {c: homomorphic.lanes(homomorphic.fingerprint(F.col(c))) for c in "abcd"}
    row = df.select(
        (f["a"] == f["b"]).alias("order"),
        (homomorphic.delete(f["a"], f["c"]) == f["d"]).alias("delete"),
        (homomorphic.insert(f["d"], f["c"]) == f["a"]).alias("insert"),
    ).first()
    assert row == (True, True, True)


def test_simhash(spark, docs, hard, empty):
    marks = [(i, brute.simhash(t)) for i, t in docs]
    expected = [(i, f"{m:016x}", c) for i, m, c in brute.groups(marks, 2)]
    assert rows(queries.op4_simhash(spark, FOLDER), "doc_id", "fingerprint", "component_id") == sorted(expected, key=repr)
    got = simhash.near_duplicates(hard.filter("doc_id is not null"))
    marks = [(i, brute.simhash(t)) for i, t in NAMED]
    assert rows(got, "doc_id", "component_id") == sorted(((i, c) for i, _, c in brute.groups(marks, 2)), key=repr)
    assert simhash.near_duplicates(hard).count() == len(HARD)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_connect_like_all_pairs(spark, radius):
    draw = random.Random(radius)
    seeds = [draw.getrandbits(64) for _ in range(30)]
    values = seeds + [s ^ sum(1 << draw.randrange(64) for _ in range(k)) for s in seeds for k in (1, 2, 3, 4)]
    marks = [(k, v & (1 << 64) - 1) for k, v in enumerate(values)]
    df = spark.createDataFrame([(i, simhash.signed(m)) for i, m in marks], "doc_id bigint, fp bigint")
    got = df.join(simhash.classes(df, radius), "fp")
    assert rows(got, "doc_id", "component_id") == sorted(((i, c) for i, _, c in brute.groups(marks, radius)), key=repr)


def test_warc(spark):
    pages = table(spark, "pages", "page_id", "html")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows(queries.op5_warc(spark, FOLDER), *columns) == sorted(brute.archive(pages), key=repr)


def test_warc_magic_in_payloads(spark):
    whole = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [
        (1, "<p>" + whole + whole + "tail"),
        (2, "WARC/1.0\r\nWARC/1.0\r\n"),
        (3, whole),
        (4, whole),
        (5, None),
        (6, ""),
        (7, "WARC/1.0\r\nContent-Length: 999999\r\n\r\n" + "é" * 2000),
        (8, "plain"),
    ]
    df = spark.createDataFrame([(i, "http://x/ y\r\n", h) for i, h in pages], "page_id bigint, url string, html string")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "1k", "100b"):  # splits inside records
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert rows(warc.round_trip(df), *columns) == sorted(brute.archive(pages), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert warc.round_trip(df.filter("1 = 0")).count() == 0
    twice = warc.round_trip(df.filter("page_id = 8").union(df.filter("page_id = 8")))
    assert rows(twice, "page_id", "record_type") == [(8, "response")] * 2
    nameless = df.withColumn("page_id", F.lit(None).cast("bigint")).filter("html = 'plain'")
    assert rows(warc.round_trip(nameless), "page_id", "record_type") == [(None, "response")]


def test_chat(spark):
    given = table(spark, "conversations", "conv_id", "turn", "role", "text")
    own = [(-7, 0, "user", queries.SAYS), (-7, 1, "assistant", queries.SAYS)]
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    assert rows(queries.op6_chat(spark, FOLDER), *columns) == sorted(brute.chats(given + own), key=repr)


def test_chat_parts_and_escapes(spark):
    part = lambda kind, text=None, ref=None, units=None: (kind, text, ref, units)
    turns = [
        (1, 0, "us:er#", [part("text", "a \\h <image 1> ###x:</turn>\n"), part("image", ref="i.png", units=2.0), part("text", "end")]),
        (1, 1, "assistant", [part("audio", ref="a.wav", units=1.5), part("document", ref="d.pdf")]),
        (1, 2, None, None),
        (1, 3, "assistant", [part("text", "\\\\h\\"), None, part("text", None)]),
        (None, 0, "assistant", [part("text", "alone")]),
    ]
    schema = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>"
    made = chat.format_chat(spark.createDataFrame(turns, schema))
    read = made.select("conv_id", "attachments", chat.read_turns(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_mask")))
    alone, first = sorted(read.collect(), key=lambda r: r[0] or 0)
    assert [tuple(t) for t in first[2]] == [
        ("us:er#", "a \\h <image 1> ###x:</turn>\n<image 1>end"), ("assistant", "<audio 2><document 3>"), ("", ""),
        ("assistant", "\\\\h\\"),
    ]
    assert first[3] == "<audio 2><document 3>\\\\h\\" and alone[3] == "alone"
    assert [tuple(a) for a in first[1]] == [(1, "image", "i.png", 512), (2, "audio", "a.wav", 38), (3, "document", "d.pdf", 700)]
    assert chat.format_chat(spark.createDataFrame([], schema)).count() == 0


def test_chat_long_conversations_clashing_columns_and_repeated_rows(spark):
    many, said = 16_000, lambda i: f"\\ah#<{i} é\U0001f600"
    part = lambda i: [("text", said(i), None, None), ("image", None, f"{i}.png", 1.0)]
    turns = [(1, i, "assistant" if i % 2 else "user", part(i), "x", 0) for i in range(many)]
    turns += [(2, 0, "assistant", part(7), "y", 1)] * 3 + [(2, None, "assistant", None, None, None)]
    schema = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>, formatted string, place int"
    made = chat.format_chat(spark.createDataFrame(turns, schema).repartition(3)).cache()
    start = time.time()
    read = made.select("conv_id", chat.read_turns(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_mask")), "attachments")
    first, second = sorted(read.collect())
    assert time.time() - start < 60
    assert [tuple(t) for t in first[1]] == [(r, f"{said(i)}<image {i + 1}>") for _, i, r, *_ in turns[:many]]
    assert first[2] == "".join(f"{said(i)}<image {i + 1}>" for i in range(1, many, 2))
    assert [(a.n, a.ref) for a in first[3]] == [(i + 1, f"{i}.png") for i in range(many)]
    assert [t.text for t in second[1]] == ["", *(f"{said(7)}<image {k}>" for k in (1, 2, 3))]
    assert second[2] == "".join(f"{said(7)}<image {k}>" for k in (1, 2, 3))


def test_repeats(spark, docs, hard, empty):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows(queries.op7_repeats(spark, FOLDER), *columns) == sorted(brute.repeats(docs), key=repr)
    once = hard.filter("doc_id is not null").dropDuplicates(["doc_id"])
    assert rows(repeats.remove_repeats(once), *columns) == sorted(brute.repeats(sorted(set(NAMED))), key=repr)
    out = repeats.remove_repeats(hard).cache()
    assert out.count() == len(HARD)
    assert out.filter("doc_id = 4").select("n_removed").distinct().count() == 1
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_with_other_lengths(spark):
    draw = random.Random(3)
    texts = [(k, "".join(draw.choice("ab é") for _ in range(draw.randrange(400)))) for k in range(60)]
    df = spark.createDataFrame(texts, DOCS)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for length, seed in ((12, 4), (9, 9), (20, 7)):
        assert rows(repeats.remove_repeats(df, length, seed), *columns) == sorted(brute.repeats(texts, length), key=repr)


def test_repeats_in_texts_longer_than_positions_reach(spark):
    draw = random.Random(9)
    passages = ["".join(draw.choice("abcdefgh é") for _ in range(60)) for _ in range(6)]
    texts = []
    for k in range(12):
        parts = ["".join(draw.choice("abcdefgh é") for _ in range(draw.randrange(5, 90))) for _ in range(12)]
        texts.append((k, "".join(p + draw.choice(passages) for p in parts)))
    df = spark.createDataFrame(texts, DOCS)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    expected = sorted(brute.repeats(texts, 20), key=repr)
    for bits in (5, 7, 9):
        assert rows(repeats.remove_repeats(df, 20, 7, bits), *columns) == expected


def test_windows_past_16_mib_meet_their_equals():
    draw = np.random.default_rng(2)
    passage = draw.integers(0, 256, 400, np.uint8)
    raw = draw.integers(0, 256, (1 << 24) + 5000, np.uint8)
    places = [1000, 4 * ((1 << 22) - 99) - 200, (1 << 24) + 3000]  # the second is over the end of a piece
    for p in places:
        raw[p : p + len(passage)] = passage
    bucket, _, first, last = repeats.cover_runs(raw, np.array([len(raw)]))
    assert first[0] == 0 and last[-1] == len(raw) - repeats.LENGTH and (first[1:] == last[:-1] + 1).all()
    met = [bucket[np.searchsorted(first, np.arange(p, p + 301), side="right") - 1] for p in places]
    assert (met[0] == met[1]).all() and (met[0] == met[2]).all()


def test_byte_bpe(spark, docs, hard, empty):
    codec = byte_bpe.Codec()
    own = tiktoken.Encoding("own", pat_str=byte_bpe.public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})

    def expected(given):
        out = []
        for i, text in given:
            ids = own.encode_ordinary(text or "")
            out.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(own.decode_bytes(ids))))
        return sorted(out, key=repr)

    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows(queries.op8_byte_bpe(spark, FOLDER), *columns) == expected(docs)
    assert rows(byte_bpe.encode_texts(hard), *columns) == expected(HARD)
    odd = ["", "a  b", "\n", " a", "a \n b", "x\ty", "ab\x1cc", "don't 12 3's", "ÿ\n\nz", "é1２ ½ x", "퟿"]
    assert [[i for e in t for i in e[3]] for t in codec.encode(odd)] == [own.encode_ordinary(t) for t in odd]
    assert byte_bpe.encode_texts(empty).count() == 0


def test_decontaminate(spark, docs, hard, empty):
    items = table(spark, "benchmark", "item_id", "text")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert rows(queries.op9_decontaminate(spark, FOLDER), *columns) == sorted(brute.contaminated(docs, items), key=repr)
    own = [(1, "cc by"), (2, "and again and again, and no one minds some words stand here again and"), (3, None), (4, "..."), (1, "cc by")]
    table_ = spark.createDataFrame(own, "item_id bigint, text string")
    assert rows(decontaminate.find_items(hard, table_), *columns) == sorted(brute.contaminated(HARD, own), key=repr)
    assert rows(decontaminate.find_items(hard, table_.filter("1 = 0")), *columns) == sorted(brute.contaminated(HARD, []), key=repr)
    assert decontaminate.find_items(empty, table_).count() == 0


def test_personal_data(spark, docs, hard, empty):
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    assert rows(queries.op10_personal_data(spark, FOLDER), *columns) == sorted(brute.personal(docs), key=repr)
    assert rows(pii.digests(pii.personal_data(hard)), *columns) == sorted(brute.personal(HARD), key=repr)
    assert pii.personal_data(empty).count() == 0
    odd = ["@foo.bar@baz.qux a@b.c@d.e x@y", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.4", "+1 (2)-3 45678901 +1234567890123456", "1-1 1  1"]
    given = list(enumerate(odd))
    assert rows(pii.digests(pii.personal_data(spark.createDataFrame(given, DOCS))), *columns) == sorted(brute.personal(given), key=repr)


def test_telling_words_are_found_and_replaced(spark):
    common = "the report was sent to everyone in the office last week"
    told = [(k, f"{common}. Quixotana wrote from q@x.example.org, number {'abcdefghij'[k]} of them") for k in range(5)]
    other = [(100 + k, f"{common} and them, so it is. {'klmnopqrst'[k % 10] * 4} of {k}") for k in range(60)]
    df = spark.createDataFrame(told + other, DOCS).withColumn("found", F.lit(1))
    terms = {r.doc_id: [(t.start, t.end) for t in r.terms] for r in pii.personal_data(df).collect()}
    for i, text in told:
        assert "quixotana" in {text[a:b].lower() for a, b in terms[i]} and "the" not in {text[a:b] for a, b in terms[i]}
    assert not any(terms[i] for i, _ in other)
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert all(clean[i] == text for i, text in other)
    assert all("@" not in clean[i] and "Quixotana" not in clean[i] and "[EMAIL]" in clean[i] for i, _ in told)


def test_telling_words_are_found_at_any_distance(spark):
    """Near the address in one text of five, and in a heading far from it in all; fewer near rows than support."""
    common = "the report was sent to everyone in the office last week and nobody had anything to add to it"
    told = [
        (k, f"Quixotana\n\n{common}. {common}. {'Mail of Quixotana came' if k < 1 else 'Mail came'} from q@x.example.org. {common}: QUIXOTANA")
        for k in range(5)
    ]
    other = [(100 + k, f"{common}. Mail came from {'klmnopqrst'[k % 10] * 4} of {k} ab{k}@y.example.org") for k in range(60)]
    elsewhere = [(500, f"{common} q2@x.example.org and not the other")]
    df = spark.createDataFrame(told + told[:1] + other + elsewhere, DOCS)
    terms = {r.doc_id: [(t.start, t.end) for t in r.terms] for r in pii.personal_data(df).collect()}
    for i, text in told:
        at = [k for k in range(len(text)) if text[k:].lower().startswith("quixotana")]
        assert terms[i] == [(a, a + len("quixotana")) for a in at] and len(at) == (3 if i < 1 else 2)
    assert not any(terms[i] for i, _ in other + elsewhere)
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert all("quixotana" not in clean[i].lower() and "[EMAIL]" in clean[i] for i, _ in told)


def test_places_of_words_are_outside_of_finds():
    text = "Anna, anna@x.example.org, 10.0.0.1anna ANNA b@anna.org"
    places = pii.term_places(text, pii.base_finds(text))
    assert [(p["start"], p["end"]) for p in places["anna"]] == [(0, 4), (34, 38), (39, 43)]
    assert places["example"] == []


def test_quality(spark, docs, hard, empty):
    out = queries.op1_quality(spark, FOLDER).cache()
    assert out.count() == len(docs)
    labels = {i: q for i, q in table(spark, "labels", "doc_id", "quality")}
    right = [r.keep == bool(labels[r.doc_id]) for r in out.collect() if r.doc_id in labels]
    kept = [r.keep for r in out.collect() if labels.get(r.doc_id) == 1]
    assert sum(right) / len(right) > 0.95 and sum(kept) / len(kept) > 0.98
    assert quality.classify(hard).count() == len(HARD)
    assert quality.classify(empty).count() == 0


def test_votes_find_labellers_accuracies():
    draw = random.Random(5)
    truth, patterns = [], {}
    for _ in range(20000):
        good = draw.random() < 0.7
        right = (0.95, 0.9, 0.8, 0.75, 0.6)
        pattern = "".join("0" if draw.random() < 0.1 else "+" if (draw.random() < p) == good else "-" for p in right)
        patterns[pattern] = patterns.get(pattern, 0) + 1
        truth.append((pattern, good))
    post, told, prior = quality.fit_votes(patterns)
    assert abs(prior - 0.7) < 0.05 and abs(told[0, 1, 1] - 0.95) < 0.04 and abs(told[4, 1, 1] - 0.6) < 0.05
    assert sum((post[p] >= 0.5) == good for p, good in truth) / len(truth) > 0.95


def test_pipeline(spark, hard, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER))
        kept[name] = docs.count()
        if name != "byte-level BPE":
            assert docs.columns == before.columns
    assert 0 < kept["byte-level BPE"] == kept["PII"] <= kept["SimHash near-dedup"] < kept["quality classifier"] < 200
    assert corpus_pipeline.run(spark, FOLDER).count() == kept["byte-level BPE"]
    wide = hard.withColumn("n_chars", F.lit(0))
    for _, stage in corpus_pipeline.STAGES:
        for given in (wide, wide.filter("1 = 0")):
            assert stage(spark, given, FOLDER).count() <= len(HARD)


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs):
    """On the given texts, on copies with a few words changed, and on a crowd of them around one text."""
    draw = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    texts = list(docs)
    for family in range(60):
        first = [draw.choice(words) for _ in range(draw.randrange(5, 300))]
        for _ in range(30 if family == 0 else 3):
            other = list(first)
            for _ in range(max(1, len(other) // draw.choice([40, 60, 90]))):
                other[draw.randrange(len(other))] = "changed"
            texts.append((len(texts) + 10_000, " ".join(other)))
        texts.append((len(texts) + 10_000, " ".join(first)))
    df = spark.createDataFrame(texts, DOCS)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(df).collect()}
    assert got == brute.near_groups(texts)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, df, FOLDER).collect()}
    assert kept == set(got.values())


def test_near_copies_in_crowds_of_texts_that_are_none(spark):
    """Texts around one long passage share bands though they are not similar enough; pairs among them are."""
    draw = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    passage = " ".join(draw.choice(words) for _ in range(300))
    texts = []
    for k in range(90):
        tail = [draw.choice(words) for _ in range(draw.randrange(60, 110))]
        texts.append((k, f"{passage} {' '.join(tail)}"))
        if k % 3 == 0:
            tail[-draw.randrange(1, 30) :] = [draw.choice(words)] * draw.randrange(1, 30)
            texts.append((1000 + k, f"{passage} {' '.join(tail)}"))
    texts += [(7, texts[0][1]), (7, texts[0][1]), (None, texts[0][1]), (2000, None), (2001, "")]
    got = {(r.doc_id, r.component_id) for r in simhash.near_copies(spark.createDataFrame(texts, DOCS)).collect()}
    named = [r for r in texts if r[0] is not None]
    assert len({c for _, c in got}) > 20
    assert {i for i, _ in got} == {i for i, _ in named}
    once = [r for r in named if r[0] != 7]  # an id of two texts joins what either is like
    alone = simhash.near_copies(spark.createDataFrame(once, DOCS)).collect()
    assert {r.doc_id: r.component_id for r in alone} == brute.near_groups(once)


def test_texts_with_finds_pass_the_pattern_that_deals_them():
    import re

    draw = random.Random(4)
    for _ in range(20_000):
        text = "".join(draw.choice("0123456789.@+ -()ab") for _ in range(draw.randrange(40)))
        assert not pii.base_finds(text) or re.search(pii.MAY_HOLD, text)
