"""Words, word hashes and shingles of Arrow text columns, by whole-array arithmetic.

A word is a run of bytes other than space and \\x09-\\x0D, as in ``[^\\x20\\x09-\\x0D]+``; bytes
of longer UTF-8 characters are never separators, so bytes and characters agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# Bytes of text handled at once: a few arrays of eight bytes per byte of text then stay in cache.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Odd numbers, so that multiplication modulo 2 ** 64 can be undone.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def least_hash(n: int, rows: int) -> int:
    """The hash (a long) up to which about twice ``n`` of ``rows`` distinct hashes lie.

    Hashes are uniform, so what is left to order has a size that depends on ``n`` alone, however many
    tasks the rows come from.
    """
    share = min(1.0, (2 * n + 100) / max(rows, 1))
    return min(int(share * 2**64) - 2**63, 2**63 - 1)


def least_hashes(hashed: Column, n: int, rows: int) -> Column:
    """Keeps about twice the ``n`` rows of least hash among ``rows``."""
    return hashed <= F.lit(least_hash(n, rows)).cast("long")


@dataclass
class Words:
    """Words of the rows ``first`` to ``first + len(rows) - 1`` of a column."""

    first: int
    data: np.ndarray  # bytes
    offsets: np.ndarray  # first byte of each row, and the number of bytes
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    rows: np.ndarray  # index of the first word of each row, and the number of words
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.rows) - 1


def words(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of a text column, some whole rows at a time."""
    data, offsets = text_bytes(column)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield _words(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], lower)
        at = to


def _words(first: int, data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    n = len(data)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    up, down = _power_tables(n + 1)
    seen = _LOWER[data] if lower else data
    sums = np.zeros(n + 1, np.uint64)
    # The polynomial of a word is a difference of running sums, moved back to the word's start.
    np.cumsum((seen.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return Words(first, data, offsets, starts, ends, np.searchsorted(starts, offsets), hashes)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 values are of no use.

    A run is the polynomial of its word hashes, so the cost does not depend on k.
    """
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    out = np.zeros(n, np.uint64)
    out[: n - k + 1] = mix((sums[k:] - sums[: n - k + 1]) * down[: n - k + 1] + np.uint64(k))
    return out


def shingle_sets(w: Words, k: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles; fewer words make one shingle."""
    hashed = runs(w.hashes, k)
    for a, b in zip(w.rows[:-1], w.rows[1:]):
        if b - a >= k:
            yield np.unique(hashed[a : b - k + 1])
        elif b > a:
            yield runs(w.hashes[a:b], int(b - a))[:1]
        else:
            yield np.zeros(0, np.uint64)
