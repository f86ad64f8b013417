"""Words of many texts at once, in numpy: spans, positions in their texts, and 64-bit word hashes.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Hashes are
polynomials over a table of random byte values, so that a word's hash does not depend on
where it stands and equal words have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.default_rng(20240607)
BYTE_VALUES = _rng.integers(1, 2**64, (2, 256), dtype=np.uint64)
BASES = [int(x) | 1 for x in _rng.integers(1, 2**63, 2, dtype=np.uint64)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def power_tables(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    have = _tables.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = _powers(BASES[which], size), _powers(pow(BASES[which], -1, 2**64), size)
        if size <= 4 * CHUNK_BYTES:
            _tables[which] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all 64 bits."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column without nulls; offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a run of texts. ``low``: their lower-cased bytes; word i is ``low[start[i]:end[i]]``.

    ``doc``: number of the text in the batch for each word; ``first``: first word of each
    text in ``docs`` and, at the end, the number of words.
    """

    docs: range
    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self, which: int = 0) -> np.ndarray:
        power, inverse = power_tables(which, len(self.low) + 1)
        sums = np.zeros(len(self.low) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[which][self.low] * power[: len(self.low)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start])


def words(column: pa.Array, chunk_bytes: int = CHUNK_BYTES, lower: bool = True) -> Iterator[Words]:
    """Cut a column of texts into runs of about ``chunk_bytes`` (at least one text) and find their words.

    Without ``lower`` the bytes, and so the hashes, keep their case.
    """
    data, offsets = binary_parts(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1)
        low = data[offsets[at] : offsets[upto]]
        low = LOWER[low] if lower else low
        bounds = offsets[at : upto + 1] - offsets[at]
        inside = ~IS_SPACE[low]
        edge = np.zeros(len(low) + 1, dtype=bool)
        edge[bounds] = True
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        before &= ~edge[:-1]
        start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        end = np.flatnonzero(inside & ~after) + 1
        first = np.searchsorted(start, bounds)
        doc = np.repeat(np.arange(at, upto), np.diff(first))
        yield Words(range(at, upto), low, start, end, doc, first)
        at = upto


class HashIndex:
    """Position of 64-bit keys in a fixed array, for whole arrays at a time (open addressing)."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.ascontiguousarray(keys, dtype=np.uint64)
        size = 1 << max(4, int(np.ceil(np.log2(max(1, len(self.keys)) * 4))))
        self.mask = U64(size - 1)
        self.slots = np.full(size, -1, dtype=np.int32)
        left, at = np.arange(len(self.keys)), (self.keys & self.mask).astype(np.int64)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several for one slot the last stays
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & int(self.mask)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each key, -1 where it is absent."""
        out = np.full(len(h), -1, dtype=np.int32)
        if not len(self.keys):
            return out
        at = (h & self.mask).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            slot = self.slots[at]
            hit = (slot >= 0) & (self.keys[slot] == h[left])
            out[left[hit]] = slot[hit]
            go = (slot >= 0) & ~hit
            left, at = left[go], (at[go] + 1) & int(self.mask)
        return out
