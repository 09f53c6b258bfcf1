"""Words of many texts as numpy arrays, from Arrow string columns.

Texts are handled in blocks of half a MB, so memory follows the block (or the
longest single text), not the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 512 << 10

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z; every other byte, those of other alphabets too, stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse modulo 2**64."""
    if len(_powers["up"]) <= n:
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n + 1, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, bytes and row offsets of consecutive blocks; null texts are empty."""
    column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + block_bytes, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
    # workers live on: what a batch has freed goes back, so that the next operator finds it
    pa.default_memory_pool().release_unused()


class Words:
    """Words of one block: byte ranges, row of each, number per row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.rows = data, offsets, len(offsets) - 1
        ink = ~IS_SPACE[data]
        first, last = ink.copy(), ink.copy()
        if len(data):
            first[1:] &= ~ink[:-1]
            last[:-1] &= ~ink[1:]
            edges = offsets[(offsets > 0) & (offsets < len(data))]
            first[edges] = ink[edges]
            last[edges - 1] = ink[edges - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.row, minlength=self.rows).astype(np.int64)
        #: index of each row's first word, and one past the last row's last
        self.bounds = np.concatenate(([0], np.cumsum(self.counts)))
        self.ink = ink

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n = len(self.data)
        up, down = _power_tables(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mixed(h ^ ((self.ends - self.starts).astype(np.uint64) << np.uint64(48)))

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word index of every run of ``k`` words inside one row."""
        if len(hashes) < k:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        m = len(hashes) - k + 1
        at = np.flatnonzero(self.row[:m] == self.row[k - 1 :])
        total = np.zeros(len(at), np.uint64)
        for i in range(k):
            total = mixed(total + hashes[at + i] + np.uint64(i))
        return total, at

    def per_row(self, mask: np.ndarray) -> np.ndarray:
        """Number of bytes of each row for which ``mask`` holds."""
        sums = np.concatenate(([0], np.cumsum(mask)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]
