"""Byte-level BPE by a SentencePiece model written straight from a rank file, and its inverse.

Every byte stands for one printable character, so a token of the rank file becomes a piece of such
characters with the negative rank as its score; the model normalises nothing and adds nothing. A text is cut
into pre-tokens by the pattern, each is encoded by the model on its own (one that is a token itself is
that token), and ids are decoded by mapping the characters of their pieces back to bytes.

Null counts as empty text and gives no ids. Texts of any length are processed whole; one pre-token may
be as long as the text. A null id is handed on, repeated rows give repeated results, an empty table an
empty one; only id and text are read.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from marginalia.llm.common import arrow_schema, batches_of, id_and_text

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Pre-tokens in a generation of what a task remembers.
REMEMBERED = 1 << 15
#: The given pattern with its commonest alternative first and its runs possessive, which matches alike:
#: no two of the alternatives before the white space can begin with the same characters.
PATTERN = r""" ?\p{L}++|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"""
#: Texts that are encoded together.
TOGETHER = 250


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: pieces by rank, then the unknown piece; BPE; identity normalisation."""
    characters, size = byte_characters(), max(ranks.values()) + 1
    pieces = [b""] * size
    for token, rank in ranks.items():
        piece = "".join(characters[b] for b in token).encode()
        pieces[rank] = _message(1, piece) + b"\x15" + struct.pack("<f", -rank) + _number(3, 1)
    for rank, piece in enumerate(pieces):  # a rank no token has
        if not piece:
            pieces[rank] = _message(1, f"␀{rank}".encode()) + b"\x15" + struct.pack("<f", -rank) + _number(3, 5)
    unknown = _message(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2)
    trainer = _number(3, 2) + _number(4, size + 1) + _number(40, size)
    for field in (41, 42, 43):  # no begin, end or padding piece
        trainer += _varint(field << 3) + _varint((1 << 64) - 1)
    normalizer = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(_message(1, p) for p in [*pieces, unknown]) + _message(2, trainer) + _message(3, normalizer)


class Codec:
    """Encoder and decoder of one vocabulary.

    Pre-tokens are remembered in two generations: when the young one is full it becomes the old one, and
    what is asked for again moves back, so frequent ones stay and memory is bounded.
    """

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        import regex
        from sentencepiece import SentencePieceProcessor

        self.ranks = read_ranks(path)
        self.model = SentencePieceProcessor(model_proto=model_bytes(self.ranks))
        characters = byte_characters()
        byte_of = {c: b for b, c in enumerate(characters)}
        self.latin = {b: c for b, c in enumerate(characters)}
        self.bytes_of = [
            bytes(byte_of.get(c, 0) for c in self.model.id_to_piece(i)) for i in range(self.model.get_piece_size() - 1)
        ]
        self.cut = regex.compile(pattern).findall
        self.young: dict[str, tuple[int, str, bytes, list[int]]] = {}
        self.old: dict[str, tuple[int, str, bytes, list[int]]] = {}

    def decode(self, ids: list[int]) -> bytes:
        """The bytes that the pieces of the ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def encode(self, texts: list[str | None]) -> list[list[tuple[int, str, bytes, list[int]]]]:
        """Per text and pre-token: how many ids, the ids as text, the bytes they decode to, the ids."""
        cut = [self.cut(text or "") for text in texts]
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        known, old, new = self.young, self.old, []
        for token in set().union(*cut).difference(known):
            if token in old:
                known[token] = old[token]
            else:
                new.append(token)
        raw = [token.encode() for token in new]
        ranks = list(map(self.ranks.get, raw))
        rest = [r.decode("latin-1").translate(self.latin) for r, rank in zip(raw, ranks) if rank is None]
        encoded = iter(self.model.encode(rest, num_threads=1) if rest else [])
        for token, rank in zip(new, ranks):
            ids = next(encoded) if rank is None else [rank]
            known[token] = len(ids), ",".join(map(str, ids)), self.decode(ids), ids
        return [list(map(known.__getitem__, tokens)) for tokens in cut]


def encode_texts(docs: DataFrame, path: str = VOCABULARY, with_ids: bool = True) -> DataFrame:
    """``(doc_id, n_tokens, [ids,] ids_sha256, decoded_sha256)`` of every row of ``docs(doc_id, text)``.

    ``path`` names the rank file where the executors find it. The decoded digest is of the bytes that
    the ids decode to, not of the text.
    """
    ddl = "doc_id bigint, n_tokens bigint, " + "ids array<int>, " * with_ids + "ids_sha256 string, decoded_sha256 string"
    out_schema = ddl
    schema = arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here forms cycles, and the many small tuples make collections slow
        codec = Codec(path)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, TOGETHER):
                    part = batch.slice(at, TOGETHER)
                    out: dict[str, list] = {name: [] for name in ("n_tokens", "ids", "ids_sha256", "decoded_sha256")}
                    for found in codec.encode(part.column(1).to_pylist()):
                        out["n_tokens"].append(sum([e[0] for e in found]))
                        out["ids"].append([i for e in found for i in e[3]] if with_ids else None)
                        out["ids_sha256"].append(hashlib.sha256(",".join([e[1] for e in found]).encode()).hexdigest())
                        out["decoded_sha256"].append(hashlib.sha256(b"".join([e[2] for e in found])).hexdigest())
                    out["doc_id"] = part.column(0).to_pylist()
                    yield batches_of(out, schema)
        finally:  # the worker goes on to other tasks
            gc.enable()
            codec.young, codec.old = {}, {}

    return id_and_text(docs).mapInArrow(run, out_schema)
