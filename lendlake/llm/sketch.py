"""Count-min sketches of 64-bit hashes, built per batch, merged by slice of cells, and held as bit maps.

A sketch has two rows of cells. A batch sends, for each slice of a row, the cells it touches as packed gaps and the counts
above one; a merge task adds one slice after another and keeps which cells reach two and which reach ``hot``. An
estimate is never below the true count, so what is not estimated repeated is not repeated.

The merged maps are at most 2 * 2**MOST_BITS bits for repeats (128 MB) and 2 * 2**HOT_BITS bits for hot hashes (4 MB), at any size
of the input; that is what is broadcast. Beyond about a billion hashes the maps fill up and more passes the filter: later steps
must be exact by themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lendlake.llm.words import mix

SLICE_BITS = 18
MOST_BITS = 29
HOT_BITS = 24
HOT = 256
BATCH_HASHES = 2_000_000
BUILDERS = 16
PAYLOAD = "slice int, gaps binary, counts binary"


def row_bits(hashes: int) -> int:
    """Bits of a cell number for about four cells per expected hash."""
    return int(np.clip(int(4 * max(1, hashes) - 1).bit_length(), SLICE_BITS, MOST_BITS))


def cells(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Cell of each hash in both rows."""
    mask = np.uint64((1 << bits) - 1)
    return [(hashes & mask).astype(np.uint32), ((hashes >> np.uint64(32)) & mask).astype(np.uint32)]


def pack_gaps(sorted_values: np.ndarray) -> bytes:
    """Increasing integers as bytes: a gap is the sum of its bytes, all 255 but the last."""
    gaps = np.diff(sorted_values.astype(np.int64), prepend=0)
    full = gaps // 255
    out = np.full(int(full.sum()) + len(gaps), 255, np.uint8)
    out[np.cumsum(full + 1) - 1] = gaps % 255
    return out.tobytes()


def unpack_gaps(packed: bytes) -> np.ndarray:
    data = np.frombuffer(packed, np.uint8)
    return np.cumsum(data, dtype=np.int64)[data < 255]


def payloads(hashes: np.ndarray, bits: int) -> pa.RecordBatch:
    """What one batch adds to the sketch, by slice; the slices of the second row follow those of the first."""
    per_row = 1 << (bits - SLICE_BITS)
    slice_ids, gaps, counts = [], [], []
    for row, cell in enumerate(cells(hashes, bits)):
        cell.sort()
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, np.int64)
        many = np.minimum(np.diff(np.r_[first, len(cell)]), 65535).astype(np.uint16)
        cell = cell[first]
        bounds = np.searchsorted(cell, np.arange(per_row + 1, dtype=np.int64) << SLICE_BITS)
        for i in np.flatnonzero(np.diff(bounds)):
            part, n = cell[bounds[i] : bounds[i + 1]] - np.uint32(i << SLICE_BITS), many[bounds[i] : bounds[i + 1]]
            over = np.flatnonzero(n > 1).astype(np.uint32)
            slice_ids.append(row * per_row + int(i))
            gaps.append(pack_gaps(part))
            counts.append(over.tobytes() + n[over].tobytes() if len(over) else b"")
    return pa.RecordBatch.from_arrays(
        [pa.array(slice_ids, pa.int32()), pa.array(gaps, pa.binary()), pa.array(counts, pa.binary())], ["slice", "gaps", "counts"]
    )


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up payloads sorted by slice; one slice is held at a time."""
    size, current = 1 << SLICE_BITS, None
    total = np.zeros(size, np.uint16)

    def result() -> pa.RecordBatch:
        twice, hot = np.packbits(total >= 2, bitorder="little"), np.flatnonzero(total >= HOT)
        arrays = [[current], [twice.tobytes()], [pack_gaps(hot)]]
        return pa.RecordBatch.from_arrays([pa.array(arrays[0], pa.int32()), *[pa.array(a, pa.binary()) for a in arrays[1:]]], ["slice", "twice", "hot"])

    for batch in batches:
        for slice_id, gaps, counts in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            if slice_id != current:
                if current is not None:
                    yield result()
                current = slice_id
                total[:] = 0
            at = unpack_gaps(gaps)
            add = np.ones(len(at), np.uint16)
            n = len(counts) // 6
            add[np.frombuffer(counts, np.uint32, n)] = np.frombuffer(counts, np.uint16, n, 4 * n)
            total[at] = np.where(total[at] > 65535 - add, 65535, total[at] + add)
    if current is not None:
        yield result()


class BitMap:
    """Which values of a column may occur in a table: bits by the top of a 64-bit hash, of a fixed size."""

    def __init__(self, bits: int = HOT_BITS):
        self.bits = bits
        self.data = np.zeros((1 << bits) // 8, np.uint8)

    def places(self, values: np.ndarray) -> np.ndarray:
        return (mix(values.astype(np.int64).view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def has(self, values: np.ndarray) -> np.ndarray:
        at = self.places(values)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def bit_map(column: DataFrame) -> BitMap:
    """The map of the one bigint column of ``column``, without nulls; slices of it are joined on the driver."""
    width = 1 << 16

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bits = BitMap(), np.zeros(1 << HOT_BITS, bool)
        for batch in batches:
            bits[own.places(batch.column(0).to_numpy())] = True
        packed = np.packbits(bits, bitorder="little").reshape(-1, width // 8)
        for i in np.flatnonzero(packed.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([int(i)], pa.int32()), pa.array([packed[i].tobytes()], pa.binary())], ["slice", "data"])

    out = BitMap()
    total = out.data.reshape(-1, width // 8)
    for row in column.coalesce(BUILDERS).mapInArrow(mark, "slice int, data binary").toLocalIterator():
        total[row["slice"]] |= np.frombuffer(bytes(row["data"]), np.uint8)
    return out


class Sketch:
    """Merged maps: which hashes may occur twice, and which may be hot."""

    def __init__(self, bits: int):
        self.bits = bits
        self.twice = np.zeros((2, max(1, (1 << bits) // 8)), np.uint8)
        self.hot = np.zeros((2, (1 << HOT_BITS) // 8), np.uint8)

    def add(self, slice_id: int, twice: bytes, hot: bytes) -> None:
        row, i = divmod(slice_id, 1 << (self.bits - SLICE_BITS))
        width = (1 << SLICE_BITS) // 8
        self.twice[row, i * width : (i + 1) * width] = np.frombuffer(twice, np.uint8)
        folded = (unpack_gaps(hot) + (i << SLICE_BITS)) & ((1 << HOT_BITS) - 1)
        np.bitwise_or.at(self.hot[row], folded >> 3, (1 << (folded & 7)).astype(np.uint8))

    def repeated(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes estimated to occur twice or more."""
        found = np.arange(len(hashes))
        for row, cell in enumerate(cells(hashes, self.bits)):
            cell = cell[found]
            found = found[(self.twice[row, cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0]
        return found

    def is_hot(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for row, cell in enumerate(cells(hashes, self.bits)):
            cell = cell & np.uint32((1 << HOT_BITS) - 1)
            out &= (self.hot[row, cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
        return out


def build(rows: DataFrame, hashes_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], expected: int) -> Sketch:
    """The sketch of all hashes that ``hashes_of`` gives for the rows' batches."""
    bits = row_bits(expected)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for hashes in hashes_of(batches):
            held.append(hashes)
            if sum(map(len, held)) >= BATCH_HASHES:
                yield payloads(np.concatenate(held), bits)
                held = []
        if held:
            yield payloads(np.concatenate(held), bits)

    parts = rows.mapInArrow(run, PAYLOAD).repartition("slice").sortWithinPartitions("slice")
    sketch = Sketch(bits)
    for row in parts.mapInArrow(merged, "slice int, twice binary, hot binary").toLocalIterator():
        sketch.add(row["slice"], bytes(row["twice"]), bytes(row["hot"]))
    return sketch
