"""What several of these operators share: row keys, words, staging in the shared folder."""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Lower-cases A-Z and turns every other byte up to 0x7F that is no digit or letter into a space. Bytes of
#: longer UTF-8 sequences stay, so the words of the result are those of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: The same words as a pattern on lower-cased text.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def byte_words(text: str | None) -> list[bytes]:
    """The lower-case words of a text as UTF-8; none for null."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def word_array(text: Column) -> Column:
    """The lower-case words of a text column; an empty array for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NO_WORD), "")


def text_hash(text: str | None) -> int:
    """What ``text_key`` gives for the same text."""
    value = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return value - (1 << 64) if value >> 63 else value


def text_key(text: Column) -> Column:
    """Part of a row's key: with the id it tells rows apart that repeat an id but not its text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def same_rows(docs: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of whole rows of ``docs`` with the keys ``(doc_id, th)`` of ``chosen``."""
    keys = chosen.select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"))
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["k_id"]) & (text_key(docs["text"]) == keys["k_th"]), how)


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that no other column can clash."""
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of columns in Spark's notation; needs a session."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def batches_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """One Arrow batch from lists of Python values."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], type=field.type) for field in schema], schema=schema
    )
