"""Personal data, and words that give it away.

Base finds are patterns with checks. Beyond them, words that stand near a find in any row are judged by how much they
tell of it over the whole corpus: for an entity e (one value of a find) and a word t, PMI(t; e) = ln(n(t, e) N / (n(t) n(e)))
against the information of the entity itself, ln(N / n(e)), with N rows, n(t) and n(e) rows that hold the word and the
entity, and n(t, e) rows that hold both, at any distance. A word that reaches ``threshold`` of that information in at
least ``support`` rows discloses the entity: wherever it stands in a row that holds the entity, outside of finds, it
becomes a span of kind ``term``. Such words are generalised to a placeholder, or removed where they disclose the entity
wholly. Rows without the entity keep the word.

All counts are over all rows. Rows are scanned in tasks; word counts are summed per task before they are
shuffled. Texts that may hold a find are scanned a second time, for all places of the words that could disclose an entity
by their counts. Which words disclose what stays in tables, joined by entity and word. Results are keyed by id and text hash,
so repeated rows give the same spans. Null and empty texts have no finds; a null id is handed on; texts are scanned
whole, in time linear in their length; an empty table gives an empty table; only id and text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import arrow_schema, batches_of, id_and_text, text_hash
from marginalia.operators.staging import staged

KINDS = ["email", "ip", "card", "phone", "term"]
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
#: From the at sign on; what stands before it is looked up backwards, so long words cost nothing.
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits does, as every match ends with one.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
WORD = re.compile(r"[^\W\d_]{2,}")

#: Words on either side of a find that are near it, and characters in which they are looked for.
NEAR_WORDS, NEAR_CHARS = 6, 120
THRESHOLD, SUPPORT, WHOLLY = 0.9, 3, 0.999
#: What every text with a find contains (for Spark's own pattern matcher); most texts do not.
MAY_HOLD = r"@[A-Za-z0-9-]+\.|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|\+[0-9]|([0-9][\x20-]?){12}"

#: Different words a task counts before it hands its counts on, and words with their places in one batch.
HELD_WORDS, HELD_PLACES = 200_000, 20_000

SCAN = (
    "doc_id bigint, th bigint, finds array<struct<kind: int, start: int, end: int>>, "
    "near array<struct<entity: bigint, term: string>>, entities array<bigint>"
)
PLACES = "doc_id bigint, th bigint, entities array<bigint>, term string, places array<struct<start: int, end: int>>"


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for m in AT_DOMAIN.finditer(text):
        at = start = m.start()
        while start > end:  # back over the local part, some characters at a time
            low = max(end, start - 64)
            run = LOCAL.search(text, low, start)
            if not run:
                break
            start = run.start()
            if start > low:
                break
        if start < at:
            end = m.end()
            yield start, end


def base_finds(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base finds, leftmost and not overlapping within their kind."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in emails(text)]
    for m in CARD.finditer(text):
        digits = DIGIT.findall(m[0])
        if 12 <= len(digits) <= 19 and luhn("".join(digits)):
            found.append((m.start(), 2, m.end()))
    if "." in text:
        for m in IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def entity_of(text: str, find: tuple[int, int, int]) -> int:
    start, kind, end = find
    value = f"{KINDS[kind]}:{text[start:end].lower()}".encode()
    return xxhash.xxh64_intdigest(value) - (1 << 63)


def near_terms(text: str, finds: list[tuple[int, int, int]]) -> tuple[list[dict], list[int]]:
    """The words near each find, outside of all finds, and the entities of the finds."""
    near, entities = set(), set()
    for find in finds:
        start, _, end = find
        entity = entity_of(text, find)
        entities.add(entity)
        left = [m.span() for m in WORD.finditer(text, max(0, start - NEAR_CHARS), start)]
        right = [m.span() for m in WORD.finditer(text, end, min(len(text), end + NEAR_CHARS))]
        if left and left[0][0] == start - NEAR_CHARS:  # it may begin before
            left = left[1:]
        if right and right[-1][1] == end + NEAR_CHARS:
            right = right[:-1]
        for a, b in left[-NEAR_WORDS:] + right[:NEAR_WORDS]:
            if not any(s < b and a < e for s, _, e in finds):
                near.add((entity, text[a:b].lower()))
    return [{"entity": e, "term": t} for e, t in sorted(near)], sorted(entities)


def term_places(text: str, finds: list[tuple[int, int, int]]) -> dict[str, list[dict]]:
    """Every word of the text with its places outside of all finds; words that stand only within them have none."""
    places: dict[str, list[dict]] = {}
    k, reach = 0, 0  # finds that begin before the word ends, and how far they go
    for m in WORD.finditer(text):
        a, b = m.span()
        while k < len(finds) and finds[k][0] < b:
            reach = max(reach, finds[k][2])
            k += 1
        own = places.setdefault(m[0].lower(), [])
        if reach <= a:
            own.append({"start": a, "end": b})
    return places


def scan(docs: DataFrame) -> DataFrame:
    """Base finds of every row, and the words near them."""
    schema = arrow_schema(SCAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            out["doc_id"] = batch.column(0).to_pylist()
            for value in batch.column(1):
                text = value.as_py() or ""
                finds = base_finds(text)
                near, entities = near_terms(text, finds) if finds else ([], [])
                out["th"].append(text_hash(text))
                out["finds"].append([{"kind": k, "start": s, "end": e} for s, k, e in finds])
                out["near"].append(near)
                out["entities"].append(entities)
            yield batches_of(out, schema)

    return id_and_text(docs).mapInArrow(run, SCAN)


def word_counts(docs: DataFrame) -> DataFrame:
    """``(term, n)``: in how many rows each word stands."""
    out_schema = "term string, n bigint"
    schema = arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(1):
                counts.update({w.lower() for w in set(WORD.findall(value.as_py() or ""))})
                if len(counts) >= HELD_WORDS:
                    yield batches_of({"term": list(counts), "n": list(counts.values())}, schema)
                    counts = Counter()
        yield batches_of({"term": list(counts), "n": list(counts.values())}, schema)

    return id_and_text(docs).mapInArrow(run, out_schema).groupBy("term").agg(F.sum("n").alias("n_term"))


def candidates(scanned: DataFrame, words: DataFrame, total: int, threshold: float, support: int) -> DataFrame:
    """``(entity, term, n_entity, n_term)``: words near an entity somewhere whose counts do not rule them out.

    Rows that hold both are at most the fewer of n_entity and n_term, which bounds the share from above."""
    pairs = scanned.select(F.explode("near").alias("p")).select("p.entity", "p.term").distinct()
    own = scanned.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    own, words = own.filter(F.col("n_entity") >= support), words.filter(F.col("n_term") >= support)
    rows = F.lit(float(max(total, 1)))
    most = F.log(rows / F.greatest("n_entity", "n_term"))
    counted = pairs.join(own, "entity").join(words, "term").select("entity", "term", "n_entity", "n_term")
    return counted.filter(most >= threshold * F.log(rows / F.col("n_entity")) - 1e-9)


def held_together(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc_id, th, entity, term, places, n_entity, n_term)`` of every row that holds both of a pair of ``wanted``."""
    schema = arrow_schema(PLACES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {name: [] for name in schema.names}
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                text = value.as_py()
                finds = base_finds(text)
                if not finds:
                    continue
                th, entities = text_hash(text), sorted({entity_of(text, f) for f in finds})
                for term, places in term_places(text, finds).items():
                    row = (doc_id.as_py(), th, entities, term, places)
                    for name, own in zip(schema.names, row):
                        out[name].append(own)
                    if len(out["term"]) >= HELD_PLACES:
                        yield batches_of(out, schema)
                        out = {name: [] for name in schema.names}
        yield batches_of(out, schema)

    may = id_and_text(docs).filter(F.col("text").rlike(MAY_HOLD))
    placed = may.mapInArrow(run, PLACES).join(wanted.select("term").distinct(), "term", "left_semi")
    each = placed.select("doc_id", "th", F.explode("entities").alias("entity"), "term", "places")
    return each.join(wanted, ["entity", "term"])


def disclosing(held: DataFrame, total: int, threshold: float, support: int) -> DataFrame:
    """``(entity, term, share)``: words that tell at least ``threshold`` of an entity's information."""
    counted = held.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("n_both"))
    information = F.log(F.lit(float(max(total, 1))) / F.col("n_entity"))
    pmi = F.log(F.col("n_both") * F.lit(float(max(total, 1))) / (F.col("n_term") * F.col("n_entity")))
    share = F.when(information > 0, pmi / information)
    told = counted.filter(F.col("n_both") >= support).select("entity", "term", share.alias("share"))
    return told.filter(F.col("share") >= threshold)


def personal_data(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``(doc_id, th, finds, terms array<struct<start, end, share>>)`` of every row of ``docs(doc_id, text)``."""
    scanned = staged(scan(docs))
    total = scanned.count()
    wanted = staged(candidates(scanned, word_counts(docs), total, threshold, support))
    held = staged(held_together(docs, wanted))
    telling = staged(disclosing(held, total, threshold, support))
    places = held.join(telling, ["entity", "term"]).select("doc_id", "th", "share", F.explode("places").alias("p"))
    places = places.select("doc_id", "th", "p.start", "p.end", "share")
    found = (
        places.groupBy("doc_id", "th")
        .agg(F.collect_set(F.struct("start", "end", "share")).alias("places"))
        .select(F.col("doc_id").alias("p_id"), F.col("th").alias("p_th"), "places")
    )
    found = staged(found)
    joined = scanned.join(found, scanned["doc_id"].eqNullSafe(found["p_id"]) & (scanned["th"] == found["p_th"]), "left")
    none = F.array().cast("array<struct<start: int, end: int, share: double>>")
    # A word near two entities is one span, with the larger share.
    ordered = F.array_sort(F.coalesce("places", none))
    once = F.filter(
        ordered,
        lambda p, i: (i == F.size(ordered) - 1) | (F.get(ordered, i + F.lit(1))["start"] != p["start"]),
    )
    return joined.select("doc_id", "th", "finds", once.alias("terms"))


def digests(found: DataFrame) -> DataFrame:
    """Counts and span lists of ``personal_data``'s rows."""
    names = F.array(*[F.lit(k) for k in KINDS])
    line = lambda p: F.concat_ws(":", F.get(names, p["kind"]), p["start"].cast("string"), p["end"].cast("string"))
    count = lambda k: F.size(F.filter("finds", lambda p: p["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    key = lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end"))
    term = lambda p: F.struct(p["start"].alias("start"), F.lit(4).alias("kind"), p["end"].alias("end"))
    base = F.array_sort(F.transform("finds", key))
    every = F.array_sort(F.concat(F.transform("finds", key), F.transform("terms", term)))
    return found.select(
        "doc_id",
        *[count(k) for k in range(4)],
        F.sha2(F.encode(F.array_join(F.transform(base, line), ","), "UTF-8"), 256).alias("base_sha256"),
        F.array_join(F.transform(every, line), ",").alias("spans"),
    )


def sanitised(text: str, finds: list, terms: list) -> str:
    """The text with finds as placeholders and disclosing words generalised, or removed if they tell all."""
    spans = sorted(
        [(f["start"], f["end"], f"[{KINDS[f['kind']].upper()}]") for f in finds]
        + [(t["start"], t["end"], "" if t["share"] >= WHOLLY else "[TERM]") for t in terms]
    )
    out, at, upto = [], 0, 0
    for start, end, mark in spans:
        if start >= upto:  # else it overlaps the one before, whose mark stands for both
            out += [text[at:start], mark]
        at = upto = max(upto, end)
    out.append(text[at:])
    return "".join(out)


def sanitise(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``docs`` with its column ``text`` sanitised, other columns as they are; a null text stays null."""
    found = personal_data(docs, threshold, support).filter("size(finds) > 0")
    found = found.groupBy("doc_id", "th").agg(F.min(F.struct("finds", "terms")).alias("found"))
    found = staged(found.select(F.col("doc_id").alias("p_id"), F.col("th").alias("p_th"), "found"))
    # Only texts that may hold a find go through the join; the others, most of all, stay where they are.
    may = F.coalesce(docs["text"].rlike(MAY_HOLD), F.lit(False))
    held = docs.filter(may)
    key = F.xxhash64(F.coalesce(held["text"], F.lit("")))
    joined = held.join(found, held["doc_id"].eqNullSafe(found["p_id"]) & (key == found["p_th"]), "left")
    renamed = found["found"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("text")
            texts, found = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            own = [t if t is None or f is None else sanitised(t, f["finds"], f["terms"]) for t, f in zip(texts, found)]
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            columns[at] = pa.array(own, type=batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    replaced = joined.select(*[held[c] for c in docs.columns], renamed.alias("_found")).mapInArrow(run, docs.schema)
    return docs.filter(~may).union(replaced)
