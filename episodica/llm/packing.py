"""Vector bin packing of token sequences under several limits at once.

Every partition of the input packs its own examples while it reads them: no
shuffle, memory bounded by the open sequences. A partition holds at most
``open_bins`` open sequences. An example's full windows become sequences of
their own, its rest goes to the open sequence with the largest dot product of
what the rest needs and what the sequence has left, both as shares of the
limits (tokens, segments, loss-bearing tokens). A rest that fits nowhere is
cut. A sequence closed before it is full, because of another limit or at the
end of the partition, is split into lengths that are powers of two, which need
no padding.

The contents of the tokenizer's added tokens, such as ``<|endoftext|>``, become
their ids where a text holds them. Null and empty texts are one end token. Ties go to the sequence opened first.
Rows that repeat are packed once each. An empty table gives no pieces. Extra
columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import in_small_batches
from episodica.llm.pretokens import WordIds, bytes_to_chars

END_ID = 0
SEQUENCE_BITS = 36
# Fewer than usual: workers of a pipeline stay beside those of earlier stages.
CACHED_WORDS = 200_000
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, loss_tokens long"
)


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024


@lru_cache(maxsize=2)
def _words(path: str) -> WordIds:
    """Ids of texts without added tokens, by the vocabulary of a byte-level BPE tokenizer file.

    Ids of such a file are the ranks of its merges, so the merges run in
    tiktoken, some four times as fast as in the file's own library and with the
    same ids (see the tests).
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    byte_of = {c: b for b, c in enumerate(bytes_to_chars())}
    special = {t["content"] for t in content["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in content["model"]["vocab"].items() if t not in special}
    coder = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return WordIds(coder.encode_ordinary, CACHED_WORDS)


@lru_cache(maxsize=2)
def _coder(path: str) -> Callable[[str | None], bytes]:
    """Whole texts to ids: added tokens have their own, wherever a text holds them, and the words lie between."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that depend on their surroundings are not supported")
    words = _words(path)
    if not added:
        return words.ids
    own = {t["content"]: t["id"].to_bytes(4, "little") for t in added}
    # The longest of those that begin at one place.
    cut = re.compile("(" + "|".join(map(re.escape, sorted(own, key=len, reverse=True))) + ")")

    def ids(text: str | None) -> bytes:
        parts = cut.split(text or "")
        return b"".join(own[x] if i % 2 else words.ids(x) for i, x in enumerate(parts))

    return ids


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int
    loss_from: int

    @property
    def size(self) -> int:
        return len(self.ids) // 4

    @property
    def loss(self) -> int:
        return max(0, self.start + self.size - max(self.start, self.loss_from))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first ``n`` tokens and the rest."""
        a, b = self.ids[: 4 * n], self.ids[4 * n :]
        return Piece(self.doc_id, self.start, a, self.doc_tokens, self.loss_from), Piece(
            self.doc_id, self.start + n, b, self.doc_tokens, self.loss_from
        )


class Packer:
    """Open sequences of one partition."""

    def __init__(self, limits: Limits, open_bins: int, first_id: int):
        self.limits, self.next_id = limits, first_id
        self.top = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=float)
        self.left = np.tile(self.top, (open_bins, 1))
        self.bins: list[list[Piece]] = [[] for _ in range(open_bins)]
        self.out: list[tuple] = []

    def emit(self, pieces: list[Piece]) -> None:
        at = 0
        for p in pieces:
            self.out.append((p.doc_id, p.start, p.size, zlib.crc32(p.ids), p.doc_tokens, self.next_id, at, p.loss))
            at += p.size
        self.next_id += 1

    def settle(self, pieces: list[Piece]) -> None:
        """Emit pieces in lengths that need no padding."""
        total = sum(p.size for p in pieces)
        if total == self.limits.tokens:
            self.emit(pieces)
            return
        queue = pieces[::-1]
        for bit in reversed(range(total.bit_length())):
            room, taken = total & (1 << bit), []
            while room:
                p = queue.pop()
                if p.size > room:
                    p, rest = p.cut(room)
                    queue.append(rest)
                taken.append(p)
                room -= p.size
            if taken:
                self.emit(taken)

    def fitting(self, p: Piece, b: int) -> int:
        """Tokens of ``p`` that sequence ``b`` can still take."""
        tokens, segments, loss = self.left[b]
        if segments < 1:
            return 0
        free = max(0, p.loss_from - p.start)
        return int(min(p.size, tokens, free + loss))

    def place(self, p: Piece, b: int) -> None:
        self.bins[b].append(p)
        self.left[b] -= (p.size, 1, p.loss)
        if self.left[b].min() < 1:
            self.settle(self.bins[b])
            self.bins[b] = []
            self.left[b] = self.top

    def add(self, doc_id: int | None, ids: bytes, loss_from: int = 0) -> None:
        whole = min(self.limits.tokens, self.limits.loss_tokens)
        p = Piece(doc_id, 0, ids, len(ids) // 4, loss_from)
        while p.size >= whole:
            head, p = p.cut(whole)
            self.settle([head])
        while p.size:
            need = np.array([p.size, 1, p.loss])
            fits = (self.left >= need).all(axis=1)
            if fits.any():
                score = np.where(fits, (self.left / self.top) @ (need / self.top), -1.0)
                self.place(p, int(score.argmax()))
                return
            # Nowhere whole: fill the sequence that can take most of it.
            room = [self.fitting(p, b) for b in range(len(self.bins))]
            b = int(np.argmax(room))
            head, p = p.cut(room[b])
            self.place(head, b)

    def close(self) -> None:
        """Gather what is still open into full sequences, and a last one."""
        rest = [p for pieces in self.bins for p in pieces]
        self.bins, self.left = [[]], self.top[None, :].copy()
        for p in rest:
            while p.size:
                head, p = p.cut(self.fitting(p, 0))
                self.place(head, 0)
        if self.bins[0]:
            self.settle(self.bins[0])

    def taken(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in PIECES.split(", ")]
        columns = list(zip(*self.out, strict=True)) or [()] * len(names)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack(
    docs: DataFrame,
    tokenizer: str,
    limits: Limits = Limits(),
    open_bins: int = 32,
    prompt_tokens: str | None = None,
) -> DataFrame:
    """Pieces of the examples ``docs`` (doc_id, text) in sequences.

    ``prompt_tokens`` names a column with the number of leading tokens of an
    example that bear no loss; without it all tokens bear loss.
    """
    if min(limits.tokens, limits.segments, limits.loss_tokens, open_bins) < 1:
        raise ValueError("limits and open_bins must be positive")
    prompt = F.col(prompt_tokens).cast("long") if prompt_tokens else F.lit(0).cast("long")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = _coder(tokenizer)
        packer = Packer(limits, open_bins, TaskContext.get().partitionId() << SEQUENCE_BITS)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            ids, texts, prompts = batch.columns
            for doc_id, text, loss_from in zip(ids.to_pylist(), texts, prompts.to_pylist(), strict=True):
                packer.add(doc_id, coded(text.as_py()) + end, loss_from or 0)
            yield packer.taken()
        packer.close()
        yield packer.taken()

    narrow = in_small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text"), prompt.alias("prompt"))
    return narrow.mapInArrow(packed, PIECES)
