"""Texts to token ids, word by word, with a bounded cache of words.

A text without adjacent white space falls apart at its single spaces and line
feeds into words that a GPT-style pattern never matches across, so that their
ids can be looked up. Any other text goes through the pattern as a whole.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

# Words kept per Python worker unless told otherwise; beyond that the cache starts anew (results do not depend on it).
CACHED_WORDS = 400_000
LONGEST_CACHED = 64

_adjacent_space = re.compile(r"\s\s")


class WordIds(dict):
    """Word, as cut by ``ids``, to its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, encode: Callable[[str], list[int]], kept: int = CACHED_WORDS):
        super().__init__()
        self.encode, self.kept = encode, kept

    def plain(self, text: str) -> bytes:
        ids = self.encode(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        out = self.plain(word if word.startswith("\n") else " " + word)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= self.kept:
                self.clear()
            self[word] = out
        return out

    def ids(self, text: str | None) -> bytes:
        """The ids of a whole text; null counts as empty."""
        if not text:
            return b""
        if _adjacent_space.search(text):
            return self.plain(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.plain(first) + b"".join(map(self.__getitem__, rest))


def bytes_to_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others, in order, for the
    code points from 256 on.
    """
    kept = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    moved = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]
