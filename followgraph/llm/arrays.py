"""Texts of one Arrow batch as numpy arrays: bytes, words and hashes.

A word is ``[^\\x20\\x09-\\x0D]+`` in UTF-8: the six separators are single
bytes that occur in no multi-byte character, so words are cut on bytes.
All hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

SEPARATORS = b" \t\n\x0b\x0c\r"
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SEPARATORS)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Letters, digits and every byte of a character beyond ASCII.
IS_ALNUM = np.array([b > 127 or chr(b).isalnum() for b in range(256)])

_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[list(SEPARATORS)] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The bytes of every text of a binary column; null reads as empty."""
    return [b"" if x is None else x for x in column.to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes, one text at least."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start = i
            size = 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    """``_BASE ** 0 .. _BASE ** (n - 1)`` modulo 2 ** 64."""
    out = np.full(max(n, 1), _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of a few texts.

    ``buf`` holds the texts joined by line feeds; ``text_start`` and
    ``text_len`` give each text's place; word ``i`` is
    ``buf[start[i]:end[i]]`` of text ``text[i]``; ``first[t]`` is the first
    word of text ``t`` (``first`` has one entry more than there are texts).
    """

    def __init__(self, texts: list[bytes], lower: bool = False, members: np.ndarray = IS_WORD):
        """``members`` tells the bytes of words; the line feed is none of them."""
        self.value = np.where(members, _BYTE, 0).astype(np.uint64)
        joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.buf = LOWER[joined] if lower else joined
        self.text_len = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(self.text_len + 1)))[:-1].astype(np.int64)
        inside = members[self.buf]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]  # the last byte is a separator, so edges pair up
        self.first = np.searchsorted(self.start, np.append(self.text_start, len(self.buf)))
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A hash for each word: a polynomial over its bytes, mixed."""
        if not len(self):
            return np.zeros(0, dtype=np.uint64)
        length = self.end - self.start
        place = np.arange(self.start[0], len(self.buf), dtype=np.int64)
        gap = np.diff(np.append(self.start, len(self.buf)))
        place -= np.repeat(self.start, gap)
        weight = powers(int(gap.max()))
        value = self.value[self.buf[self.start[0] :]] * weight[place]
        return mix(np.add.reduceat(value, self.start - self.start[0]) + length.astype(np.uint64))


def grams(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``n`` words inside one text, and the index of its first word."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    out = hashes[:count].copy()
    for j in range(1, n):
        out *= _BASE
        out += hashes[j : count + j]
    at = np.flatnonzero(text[:count] == text[n - 1 : n - 1 + count])
    return mix(out[at]), at
