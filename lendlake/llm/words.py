"""Words of Arrow text batches as numpy arrays: bounds and 64-bit hashes, without a Python loop over words.

A word is a maximal run of bytes other than space and tab to carriage return, so that it
equals a match of ``[^\\x20\\x09-\\x0D]+``. A null text has no words. Hashes are those of the
word's UTF-8 bytes; ``lower`` takes A-Z as a-z.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PATTERN = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20
BLOCK = 1 << 17

_word_byte = np.ones(256, bool)
_word_byte[[0x20, *range(0x09, 0x0E)]] = False
_rng = np.random.default_rng(20240607)
_codes = {False: _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)}
_codes[True] = _codes[False].copy()
_codes[True][0x41:0x5B] = _codes[False][0x61:0x7B]
_factors = _rng.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_base = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices of about ``limit`` text bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in one array, and where each row begins; a null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def _power_tables(size: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < size:
        size = max(size, 2 * BLOCK)
        bases = [_base, pow(_base, -1, 1 << 64)]
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in bases]
    return _powers


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits; one to one."""
    values = values ^ (values >> np.uint64(33))
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


class Words:
    """Word bounds of a text column: ``starts``, ``ends``, and ``first[i]``, the first word of row i."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = text_bytes(column)
        inside = _word_byte[self.data]
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        filled = self.offsets[:-1] < self.offsets[1:]
        before[self.offsets[:-1][filled]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        after[self.offsets[1:][filled] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word, in blocks that fit into a core's cache."""
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(out):
            low = self.starts[at]
            stop = max(at + 1, int(np.searchsorted(self.ends, low + BLOCK, "right")))
            high = self.ends[stop - 1]
            power, inverse = _power_tables(int(high - low) + 1)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_codes[lower][self.data[low:high]] * power[: high - low], out=sums[1:])
            begin, end = self.starts[at:stop] - low, self.ends[at:stop] - low
            out[at:stop] = (sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * _factors[-1]
            at = stop
        return mix(out)

    def windows(self, hashes: np.ndarray, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word numbers) and hashes of all runs of ``size`` words within one row."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for j in range(size):
            total += hashes[j : j + n] * _factors[(j + 17 * salt) % 4095]
        last = np.repeat(self.first[1:], self.counts)[:n]
        at = np.flatnonzero(np.arange(n) + size <= last)
        return at, mix(total[at] + np.uint64(salt))
