"""Words of whole texts as numbers, by array operations over a batch of UTF-8 bytes.

Word separators are ASCII bytes in both word rules used here, so words can be
cut in UTF-8 without decoding. A word's number is a 64-bit polynomial hash of
its bytes (through a table of random values), finished by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes scanned at a time; a longer row is cut at a separator.
SEGMENT = 1 << 19

_RANDOM = np.random.default_rng(20_240_917)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class _Powers:
    up = _powers(_BASE, SEGMENT + 1)
    down = _powers(_BASE_INVERSE, SEGMENT + 1)

    @classmethod
    def reach(cls, n: int) -> None:
        if n >= len(cls.up):
            cls.up, cls.down = _powers(_BASE, 2 * n), _powers(_BASE_INVERSE, 2 * n)


def word_bytes(separators: str) -> np.ndarray:
    """A table that says of each byte whether it belongs to a word, given the ASCII separators."""
    table = np.ones(256, bool)
    table[[ord(c) for c in separators]] = False
    return table


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective bit mixer on unsigned 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words(NamedTuple):
    """Words of the rows lo..hi-1 of a batch, in order; ``row`` counts from lo."""

    lo: int
    hi: int
    row: np.ndarray
    number: np.ndarray

    def bounds(self) -> np.ndarray:
        """Row r has the words bounds[r]..bounds[r + 1] - 1."""
        return np.searchsorted(self.row, np.arange(self.hi - self.lo + 1))


def _scan(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    data = _LOWER[data]
    inside = is_word[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    _Powers.reach(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _Powers.up[:n], out=sums[1:])
    number = (sums[end] - sums[start]) * _Powers.down[start]
    number = mixed(number ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return np.searchsorted(offsets, start, side="right") - 1, number


def words(texts: pa.Array, is_word: np.ndarray) -> Iterator[Words]:
    """The words of each whole text (A-Z lower-cased), for some rows at a time. Null has none."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SEGMENT, side="right")) - 1)
        if offsets[hi] - offsets[lo] <= SEGMENT or hi > lo + 1:
            row, number = _scan(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], is_word)
        else:
            parts = [_scan(p, np.array([0, len(p)]), is_word)[1] for p in _cut(data[offsets[lo] : offsets[hi]], is_word)]
            number = np.concatenate(parts)
            row = np.zeros(len(number), np.int64)
        yield Words(lo, hi, row, number)
        lo = hi


def _cut(data: np.ndarray, is_word: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end before a separator."""
    at = 0
    while at < len(data):
        size = SEGMENT
        while True:
            end = min(len(data), at + size)
            gaps = np.flatnonzero(~is_word[_LOWER[data[at + 1 : end]]]) if end < len(data) else ()
            if end == len(data) or len(gaps):
                break
            size *= 2
        if end < len(data):
            end = at + 1 + int(gaps[-1])
        yield data[at:end]
        at = end


def shingles(number: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the runs of ``size`` words that stay in a row, and the index of their first word."""
    n = len(number) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = number[:n].copy()
    for k in range(1, size):
        total = total * np.uint64(_BASE) + number[k : k + n]
    at = np.flatnonzero(row[:n] == row[size - 1 :])
    return mixed(total[at] ^ np.uint64(size)), at
