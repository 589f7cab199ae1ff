"""WARC archives of pages: written with revisit records, read back by boundary chains.

Writing: pages whose payloads are equal share one response record, of the largest page_id; the others become revisit
records that name it, with the payload's digest and length and no payload. A record is one line of Spark's
text writer with the record's closing line feeds as line separator, so lost tasks are redone by its committer.

Reading: the archives are split at the magic line, wherever it stands, so pieces are found in parallel at any split of a
file. Each piece is a candidate record: its offset follows from the lengths of the pieces before it in its split and of the
splits before that, its successor from its Content-Length. Candidates whose successor is the next one form runs;
from the start of each file the reachable runs are found by pointer jumping, which doubles the distance each round.
Candidates that are not reachable are magic lines inside payloads. Records whose payload holds such lines are put
together from their pieces in a second read.

A null html is an empty payload. Rows that repeat page_id and payload of a response are responses too; a null
page_id is smaller than any other, and pages without any id of the same payload are all responses. Urls have white space
and control characters escaped; other columns are not read; an empty table gives empty archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.llm.common import arrow_schema, batches_of
from marginalia.operators.staging import staged, staged_path

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
RECORDS_PER_FILE = 50_000

PIECES = (
    "file string, block bigint, seq bigint, own_at bigint, size bigint, step bigint, page_id string, kind string, "
    "refers string, digest string, bytes bigint, whole boolean"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits are four base-32 digits, in RFC 4648's letters."""
    digits = F.sha1(payload)
    quads = [
        F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, html, digest, n, refers)`` of ``pages(page_id, url, html)``; ``refers`` is null in responses."""
    own = pages.select(
        "page_id",
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumns({"digest": base32_sha1(F.encode("html", "UTF-8")), "n": F.octet_length("html").cast("bigint")})
    shared = (
        own.filter(F.col("n") >= min_bytes)
        .groupBy(F.col("digest").alias("same"), F.col("n").alias("same_n"))
        .agg(F.max("page_id").alias("top"), F.count("*").alias("times"))
        .filter("times > 1 and top is not null")
        .select("same", "same_n", "top")
    )
    shared = staged(shared)
    joined = own.join(shared, (own["digest"] == shared["same"]) & (own["n"] == shared["same_n"]), "left")
    revisits = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return joined.select("page_id", "url", "html", "digest", "n", F.when(revisits, F.col("top")).alias("refers"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write WARC files of ``pages`` to the folder ``path``."""
    field = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    own = records(pages, min_bytes)
    revisit = F.col("refers").isNotNull()
    nothing = F.lit("")
    header = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", uri(F.col("page_id"))),
        field("WARC-Target-URI", F.col("url")),
        F.when(revisit, field("WARC-Refers-To", uri(F.col("refers")))).otherwise(nothing),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, field("X-Payload-Length", F.col("n").cast("string"))).otherwise(nothing),
        field("Content-Length", F.when(revisit, "0").otherwise(F.col("n").cast("string"))),
        F.lit("\r\n"),
    )
    line = F.concat(header, F.when(revisit, nothing).otherwise(F.col("html")))
    writer = own.select(line.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file)
    writer.text(path)


def _header(piece: bytes) -> tuple[dict[bytes, bytes], int]:
    """The fields of a piece that begins with a record's header, and where its block begins; or nothing, -1."""
    stop = piece.find(b"\r\n\r\n")
    if stop < 0:
        return {}, -1
    fields = {}
    for line in piece[:stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            return {}, -1
        fields[name.lower()] = value.strip()
    return fields, stop + 4


def _urn(value: bytes | None) -> str | None:
    return value.decode(errors="replace").removeprefix("<urn:page:").removesuffix(">") if value else None


def _candidate(piece: bytes) -> dict:
    """What a piece says of itself; ``step`` is from its magic to its successor, null if it is no record."""
    fields, at = _header(piece)
    length = fields.get(b"content-length", b"")
    out = dict.fromkeys(("step", "page_id", "kind", "refers", "digest", "bytes", "whole"))
    if at < 0 or not length.isdigit() or len(length) > 15:
        return out
    n = int(length)
    out["step"] = len(MAGIC) + at + n + len(END)
    out["kind"] = fields.get(b"warc-type", b"").decode(errors="replace")
    out["page_id"], out["refers"] = _urn(fields.get(b"warc-record-id")), _urn(fields.get(b"warc-refers-to"))
    out["whole"] = len(piece) == at + n + len(END) and piece.endswith(END.encode())
    said = fields.get(b"x-payload-length", b"")
    if out["kind"] == "revisit" and said.isdigit():
        out["digest"] = fields.get(b"warc-payload-digest", b"").decode(errors="replace").removeprefix("sha1:")
        out["bytes"] = int(said)
    elif out["whole"]:
        out["digest"] = base64.b32encode(hashlib.sha1(piece[at : at + n]).digest()).decode()
        out["bytes"] = n
    return out


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary").alias("value"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(file, split, number in it, offset in it, bytes) of pieces, as a task reads them in order."""
    last, seq, at = None, 0, 0
    for batch in batches:
        for file, block, value in zip(*[batch.column(k) for k in range(3)]):
            key, piece = (file.as_py(), block.as_py()), value.as_py()
            if key != last:
                last, seq, at = key, 0, 0
            yield *key, seq, at, piece
            seq, at = seq + 1, at + len(piece) + len(MAGIC)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row for each piece: where it stands in its split, and what record it would be."""
    schema = arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {name: [] for name in schema.names}
        for file, block, seq, at, piece in _numbered(batches):
            row = {"file": file, "block": block, "seq": seq, "own_at": at, "size": len(piece) + len(MAGIC)}
            for name, value in {**row, **_candidate(piece)}.items():
                out[name].append(value)
            if len(out["file"]) >= 1000:
                yield batches_of(out, schema)
                out = {name: [] for name in schema.names}
        yield batches_of(out, schema)

    return _pieces(spark, path).mapInArrow(run, PIECES)


def _placed(found: DataFrame) -> DataFrame:
    """Candidates with their offset in the file. A piece is cut off at a magic line, so it starts after one."""
    splits = found.groupBy("file", "block").agg(F.sum("size").alias("all"))
    before = F.sum("all").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    base = splits.select(F.col("file").alias("f"), F.col("block").alias("b"), F.coalesce(before, F.lit(0)).alias("base"))
    joined = found.join(base, (found["file"] == base["f"]) & (found["block"] == base["b"]))
    return joined.withColumn("offset", F.col("base") + F.col("own_at") - F.lit(len(MAGIC))).drop("f", "b", "base", "own_at")


def _reachable(placed: DataFrame) -> DataFrame:
    """``(file, offset)`` of the candidates on the chain from each file's start."""
    split = Window.partitionBy("file", "block").orderBy("offset")
    # The last candidate of a split ends its run there; runs are joined by jumping.
    linked = placed.filter("offset >= 0").select(
        "file", "block", "offset", (F.col("offset") + F.col("step")).alias("next"),
        F.lead("offset").over(split).alias("after"),
    )
    broken = linked.withColumn("tail", ~F.coalesce(F.col("next") == F.col("after"), F.lit(False)))
    prior = F.sum(F.col("tail").cast("int")).over(split.rowsBetween(Window.unboundedPreceding, -1))
    marked = staged(broken.withColumn("run", F.coalesce(prior, F.lit(0))))
    runs = marked.groupBy("file", "block", "run").agg(
        F.min("offset").alias("head"), F.max(F.when(F.col("tail"), F.col("next"))).alias("to")
    )
    # A chain may enter a run anywhere, so nodes are run heads and every place that some run leads to.
    inside = marked.select("file", F.col("offset").alias("head"), "block", "run")
    targets = runs.select("file", F.col("to").alias("head")).filter("head is not null").distinct()
    entries = inside.join(targets, ["file", "head"])
    starts = inside.filter("head = 0")
    nodes = entries.unionByName(starts).distinct()
    ends = runs.select("file", "block", "run", "to")
    jump = staged(nodes.join(ends, ["file", "block", "run"]).select("file", F.col("head").alias("node"), "to"))
    reached, hop = staged(starts.select("file", F.col("head").alias("node"))), jump
    size = reached.count()
    while True:
        step = reached.join(hop, ["file", "node"]).select("file", F.col("to").alias("node")).filter("node is not null")
        reached = staged(reached.union(step).distinct())
        grown = reached.count()
        if grown == size:
            break
        size = grown
        further = hop.select("file", F.col("node").alias("to"), F.col("to").alias("beyond"))
        hop = staged(hop.join(further, ["file", "to"]).select("file", "node", F.col("beyond").alias("to")))
    entered = reached.select("file", F.col("node").alias("offset"))
    first = (
        marked.join(entered, ["file", "offset"])
        .groupBy("file", "block", "run").agg(F.min("offset").alias("entry"))
    )
    return marked.join(first, ["file", "block", "run"]).filter("offset >= entry").select("file", "offset")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every record under ``path``."""
    placed = staged(_placed(candidates(spark, path)))
    reached = staged(_reachable(placed).withColumn("real", F.lit(True)))
    kept = placed.join(reached, ["file", "offset"])
    fields = ["page_id", "bytes", "digest", "kind", "refers"]
    done = kept.filter("bytes is not null").select(*fields)
    parts = staged(kept.filter("bytes is null").select("file", "offset", "step", *fields))
    if parts.limit(1).count():  # payloads that hold magic lines
        done = done.unionByName(_joined(spark, path, placed, parts).select(*fields))
    return done.select(
        F.expr("try_cast(page_id as bigint)").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when(F.col("kind") == "revisit", F.expr("try_cast(refers as bigint)")).alias("refers_to"),
    )


def _joined(spark: SparkSession, path: str, placed: DataFrame, parts: DataFrame) -> DataFrame:
    """Payload lengths and digests of records that several pieces make up; the pieces are read again."""
    heads = parts.select("file", F.col("offset").alias("head"), F.col("step").alias("long"))
    grouped = heads.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("head", "long"))).alias("heads"))
    within = F.filter("heads", lambda h: (h["head"] <= F.col("offset")) & (F.col("offset") < h["head"] + h["long"]))
    wanted = (
        placed.join(grouped, "file").select("file", "block", "seq", "offset", F.get(within, 0)["head"].alias("head"))
        .filter("head is not null")
    )
    wanted = staged(wanted)
    schema = "file string, block bigint, seq bigint, piece binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, seq, _, piece in _numbered(batches):
            yield batches_of({"file": [file], "block": [block], "seq": [seq], "piece": [piece]}, arrow)

    again = _pieces(spark, path).mapInArrow(run, schema)
    gathered = again.join(wanted, ["file", "block", "seq"]).groupBy("file", "head").agg(
        F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("pieces")
    )
    out_schema = "file string, offset bigint, bytes bigint, digest string"
    out_arrow = arrow_schema(out_schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"file": batch.column(0).to_pylist(), "offset": batch.column(1).to_pylist()}
            out["bytes"], out["digest"] = [], []
            for pieces in batch.column(2).to_pylist():
                record = MAGIC.encode().join(p["piece"] for p in pieces)
                fields, at = _header(record)
                n = int(fields[b"content-length"])
                payload = record[at : at + n]
                out["bytes"].append(len(payload))
                out["digest"].append(base64.b32encode(hashlib.sha1(payload).digest()).decode())
            yield batches_of(out, out_arrow)

    found = gathered.mapInArrow(digest, out_schema)
    return parts.drop("bytes", "digest").join(found, ["file", "offset"])


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = staged_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
