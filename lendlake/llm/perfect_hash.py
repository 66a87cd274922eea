"""Sharded minimal perfect hashes of distinct 128-bit keys, with a fingerprint and two values for each key.

A shard holds the keys with the same top bits. It is built level by level: a level has about 1.5 bits for each key still without a place; a key
that is alone in its bit is placed there, the others go on to the next level, which hashes anew. The number of set bits before a key's bit is its
place in the arrays, so n keys have the places 0 to n - 1 and take about 3.5 bits each. A key that is not in the index may meet a set
bit; its fingerprint, the 64 bits that the shard's top bits are not taken from, tells it from the key there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lendlake.llm.words import mix

SHARD_KEYS = 1 << 14
SPACE = 1.5
STEP = 0x9E3779B97F4A7C15
SHARD = "shard int, sizes array<int>, bits binary, prints binary, counts binary, keepers binary"
NAMES = [field.split()[0] for field in SHARD.split(", ")]


def shard_bits(keys: int) -> int:
    """Top bits that give shards of about SHARD_KEYS keys; 1 to 31."""
    return min(31, max(1, (max(1, keys) // SHARD_KEYS).bit_length()))


def shard_of(high: np.ndarray, bits: int) -> np.ndarray:
    return (high >> np.uint64(64 - bits)).astype(np.int64)


def _cells(high: np.ndarray, low: np.ndarray, level: int, sizes: np.ndarray) -> np.ndarray:
    turned = mix(high + np.uint64((level + 1) * STEP & 0xFFFFFFFFFFFFFFFF))
    return (mix(turned ^ low) % sizes.astype(np.uint64)).astype(np.int64)


def built(shard: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> pa.RecordBatch:
    """One shard as a row; the keys are distinct."""
    sizes, words, order = [], [], []
    left = np.arange(len(high))
    while len(left):
        size = 64 * int(np.ceil(SPACE * len(left) / 64))
        cell = _cells(high[left], low[left], len(sizes), np.full(len(left), size))
        alone = np.bincount(cell, minlength=size) == 1
        placed = alone[cell]
        order.append(left[placed][np.argsort(cell[placed])])
        words.append(np.packbits(alone, bitorder="little"))
        sizes.append(size)
        left = left[~placed]
    at = np.concatenate(order)
    parts = [np.concatenate(words), low[at], np.minimum(counts[at], 0xFFFFFFFF).astype(np.uint32), keepers[at]]
    binary = [pa.array([p.tobytes()], pa.binary()) for p in parts]
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([sizes], pa.list_(pa.int32())), *binary], NAMES)


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, h1, h2, n, keeper) sorted by shard become one row a shard; one shard is held at a time."""
    held: list[pa.RecordBatch] = []

    def done() -> pa.RecordBatch:
        columns = [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(1, 5)]
        return built(held[0].column(0)[0].as_py(), columns[0].view(np.uint64), columns[1].view(np.uint64), *columns[2:])

    for batch in batches:
        numbers = batch.column(0).to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for start, stop in zip(bounds, bounds[1:], strict=False):
            if start == stop:
                continue
            if held and held[0].column(0)[0].as_py() != numbers[start]:
                yield done()
                held = []
            held.append(batch.slice(start, stop - start))
    if held:
        yield done()


class Index:
    """The arrays of several shards, probed for many keys at once."""

    def __init__(self, bits: int, rows: list[dict]):
        self.bits = bits
        rows = sorted(rows, key=lambda r: r["shard"])
        self.shards = np.array([r["shard"] for r in rows] or [-1], np.int64)
        levels = max((len(r["sizes"]) for r in rows), default=0)
        self.sizes = np.zeros((len(self.shards), levels), np.int64)
        self.begins = np.zeros((len(self.shards), levels), np.int64)
        begin = 0
        for i, r in enumerate(rows):
            sizes = np.asarray(r["sizes"], np.int64)
            self.sizes[i, : len(sizes)] = sizes
            self.begins[i, : len(sizes)] = begin + np.cumsum(sizes) - sizes
            begin += int(sizes.sum())
        joined = {name: b"".join([bytes(r[name]) for r in rows]) for name in NAMES[2:]}
        self.words = np.frombuffer(joined["bits"], np.uint64)
        self.ranks = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)
        self.prints = np.frombuffer(joined["prints"], np.uint64)
        self.counts = np.frombuffer(joined["counts"], np.uint32)
        self.keepers = np.frombuffer(joined["keepers"], np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for keys that are not in the index."""
        places = np.full(len(high), -1, np.int64)
        number = shard_of(high, self.bits)
        shard = np.minimum(np.searchsorted(self.shards, number), len(self.shards) - 1)
        left = np.flatnonzero(self.shards[shard] == number)
        for level in range(self.sizes.shape[1]):
            sizes = self.sizes[shard[left], level]
            left, sizes = left[sizes > 0], sizes[sizes > 0]
            bit = self.begins[shard[left], level] + _cells(high[left], low[left], level, sizes)
            word, below = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> below) & np.uint64(1) > 0
            before = np.bitwise_count(word[hit] & ((np.uint64(1) << below[hit]) - np.uint64(1)))
            places[left[hit]] = self.ranks[bit[hit] >> 6] + before
            left = left[~hit]
        known = np.flatnonzero(places >= 0)
        other = self.prints[places[known]] != low[known]
        places[known[other]] = -1
        return places
