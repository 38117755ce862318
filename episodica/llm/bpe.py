"""Byte-level BPE through a sentencepiece model written from the vocabulary.

The model is serialised here, not trained: one piece per token, its bytes
mapped to printable characters, scored by the negative rank, so that the
best-scored merge is the one with the lowest rank; the normaliser is the
identity. Texts are split by a pattern and each match is encoded separately.
Decoding maps each id back to its piece and the piece to its bytes.

Null text counts as empty, an empty text has no ids, repeated rows are encoded
each, an empty table gives an empty table. Result columns that exist in the
input already are replaced.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.llm.common import in_small_batches
from episodica.llm.pretokens import WordIds, bytes_to_chars

# Fields of the public protobuf schema of sentencepiece models.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, BPE = 1, 2, 2


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a vocabulary; piece ids follow the ranks, the unknown piece is last."""
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary lacks single bytes")
    chars = bytes_to_chars()
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = "".join(chars[b] for b in token).encode()
        out.append(_block(PIECE, _block(1, piece) + _float(2, -float(rank)) + _number(3, NORMAL)))
    out.append(_block(PIECE, _block(1, b"<unk>") + _float(2, 0.0) + _number(3, UNKNOWN)))
    n = len(ranks)
    absent = (1 << 64) - 1  # -1
    out.append(_block(TRAINER, _number(3, BPE) + _number(4, n + 1) + _number(40, n) + b"".join(_number(k, absent) for k in (41, 42, 43))))
    out.append(_block(NORMALIZER, _block(1, b"identity") + b"".join(_number(k, 0) for k in (3, 4, 5))))
    return b"".join(out)


class Coder:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.by_piece = sorted(self.ranks.values())
        # Rust's and Python's \s differ in a few control characters; the vocabulary's library has the property's meaning.
        self.find = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.char_map = {b: c for b, c in enumerate(bytes_to_chars())}
        byte_of = {c: b for b, c in self.char_map.items()}
        self.token = {
            rank: bytes(byte_of[c] for c in self.model.id_to_piece(i)) for i, rank in enumerate(self.by_piece)
        }
        self.words = WordIds(self.encode)

    def encode(self, text: str) -> list[int]:
        out = []
        for match in self.find(text):
            raw = match.encode()
            if (rank := self.ranks.get(raw)) is not None:
                out.append(rank)
            else:
                mapped = raw.decode("latin-1").translate(self.char_map)
                out += [self.by_piece[i] for i in self.model.encode(mapped)]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I").tolist()))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def _mapped(df: DataFrame, source: str, target: str, convert) -> DataFrame:
    """Add the binary column ``target``: ``convert()`` gives the function of one value of ``source``."""
    rest = [c for c in df.columns if c != target]
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(target, T.BinaryType())])
    at = rest.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = convert()
        for batch in batches:
            made = pa.array([one(x.as_py()) for x in batch.column(at)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*rest, target])

    return in_small_batches(df).select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of ``text`` as little-endian unsigned 32-bit integers in one binary value."""
    return _mapped(df, text, ids, lambda: coder(path, pattern).words.ids)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes that ``ids`` stand for; null ids count as none."""
    return _mapped(df, ids, decoded, lambda: lambda x: coder(path, pattern).decode(x or b""))
