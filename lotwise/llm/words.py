"""Vectorised words of whole texts: an Arrow text column to word spans and 64-bit word hashes.

All texts of a slice lie in one byte buffer, so splitting and hashing cost a few numpy passes over
bytes and no Python work per row. A slice holds about ``SLICE_BYTES`` of text (one text at least),
which bounds a worker's memory by the longest text and not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # bytes of text handled at once
SMALL_SLICE = 1 << 20  # where more is made of each word
GOLDEN, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB  # splitmix64
BASE_BYTE, BASE_WORD = 0x5851F42D4C957F2D, 0xD1342543DE82EF95  # odd, so invertible mod 2**64

# Classes of word bytes. Every byte of a non-ASCII character is at least 0x80.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LETTERS_DIGITS = np.zeros(256, bool)  # after A-Z became a-z
LETTERS_DIGITS[0x30:0x3A] = LETTERS_DIGITS[0x61:0x7B] = LETTERS_DIGITS[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, kept and grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        filled = 1
        while filled < size:
            factor = np.uint64(pow(base, filled, 1 << 64))
            have[filled:2 * filled] = have[:filled] * factor
            filled *= 2
        _POWERS[base] = have
    return have[:n]


def _span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span, by one prefix array mod 2**64."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=prefix[1:])
    inverse = _powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mix64((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


@dataclass
class Slice:
    """Rows ``lo:hi`` of a batch: their bytes, and where each text starts (one more at the end)."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.hi - self.lo


@dataclass
class Words:
    """Words of a slice in order: byte span, row within the slice, hash; ``first`` has each row's
    first word (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def text_slices(column: pa.Array, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column (null: empty) in slices of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = (pc.fill_null(column, "") if column.null_count else column).cast(pa.large_string())
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        part = data[offsets[lo]:offsets[hi]]
        yield Slice(lo, hi, LOWER[part] if lower else part, offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def split(s: Slice, word_bytes: np.ndarray = NOT_SPACE) -> Words:
    """Maximal runs of word bytes of each text, with their hashes."""
    inside = word_bytes[s.data]
    cut = np.zeros(len(s.data) + 1, bool)  # a text starts here
    cut[s.offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    first = np.searchsorted(start, s.offsets)
    row = np.repeat(np.arange(s.rows), np.diff(first))
    return Words(start, end, row, first, _span_hashes(_byte_values()[s.data], start, end, BASE_BYTE))


def prefix_hashes(s: Slice, w: Words, n_bytes: int) -> np.ndarray:
    """Hash of the first ``n_bytes`` bytes of each word (of all of it, if shorter)."""
    end = np.minimum(w.end, w.start + n_bytes)
    return _span_hashes(_byte_values()[s.data], w.start, end, BASE_BYTE)


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``k`` words within one text: index of the first word, and hash."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.row[:n - k + 1] == w.row[k - 1:])
    return at, _span_hashes(w.hash, at, at + k, BASE_WORD)


def sequence_hashes(w: Words) -> np.ndarray:
    """Hash of each row's whole word sequence (its gram of all words)."""
    return _span_hashes(w.hash, w.first[:-1], w.first[1:], BASE_WORD)
