"""Texts as bytes in numpy: lengths, 8-byte windows, words and their hashes, many texts at a time.

All functions take the concatenated bytes of several texts; nothing crosses from one text to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd base of the polynomial over bytes modulo 2^64, and its inverse.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

# ASCII A-Z to a-z; every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# White space: space and the characters from tab to carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def encode(texts) -> list[bytes]:
    """UTF-8 of each text of an Arrow column or list; null counts as empty."""
    if isinstance(texts, pa.Array):
        texts = texts.cast(pa.binary()).to_pylist()
    return [b"" if t is None else t if isinstance(t, bytes) else t.encode("utf-8", "replace") for t in texts]


def parts(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive items of at most `most` bytes together; a larger item stands alone."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixing of unsigned 64-bit numbers; one to one."""
    x = x * U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    return x


def windows8(data: bytes, extra: int) -> np.ndarray:
    """The 8 bytes from each position as a number; `extra` zero bytes are thought behind the data."""
    padded = data + bytes(extra + 8)
    return np.ndarray((len(data) + extra,), dtype="<u8", buffer=padded, strides=(1,)).copy()


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U64(base & (2**64 - 1)))
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class RangeHash:
    """Hashes of any byte ranges of one buffer: equal ranges have equal hashes, whatever stands before them."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum((values.astype(U64) + U64(1)) * powers(BASE, n), out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(U64))


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of each maximal run of bytes that are not white space.

    `ends` are the ends of the texts in `data`; a word ends with its text.
    """
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = ends[:-1][ends[:-1] < len(data)]
    first[begins] |= inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    stops = ends[(ends > 0)] - 1
    last[stops] |= inside[stops]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(ends, start, "right")
