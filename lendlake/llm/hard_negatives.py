"""Hard negatives: rows of another label that score nearly as high for an anchor as one of its positives, read by zone maps.

Rows have an id, a label and a vector of whole numbers; the score of two rows is their inner product. An anchor's positives are its first rows of the
same label. For each of them, the negatives are the first rows of other labels in its window: scores from ``low`` to ``high`` percent of the
positive's. Higher scores come first, then smaller ids.

Rows are sorted along a Hilbert curve through their quantised components and cut into blocks, rows of a Parquet table with the least and the
greatest value of each component and of the label (zone maps). Interval arithmetic bounds the scores of an anchor with all rows of a block:
a component a takes from a block with values lo to hi at most max(a lo, a hi).

An anchor first meets its own block. What it finds there is a bound: a block whose scores all lie below the k-th positive found cannot change
the positives. The blocks left are read, and the positives are final. Windows follow in the same way: the own block gives each window a least score, and a block is
read if the interval of its scores meets what is left of some window. Bounds never leave out a row that counts, ties included.

Anchors travel in tiles, those of TILE_BLOCKS blocks that follow each other, and a tile meets a block only for the anchors that ask for it. Zone maps meet
tiles in pages of ZONES. All of these are joins on equal keys; a block that many tiles ask for is split by adaptive execution. Nothing is broadcast.

Rows without id, label or vector, or with a null component, take no part. Rows with one id are one row, the one greatest by label, then vector. Vectors of
other lengths have no score. Components are cut to 2**24 on either side, so that sums stay exact. Other columns are not used; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake.sources.scratch import written

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
BLOCK_ROWS = 512
TILE_BLOCKS = 16
ZONES = 512
PARTITION_BLOCKS = 8
BITS = 4
MOST = 1 << 24
LEAST_SCORE = -(1 << 62)
BLOCK = "block bigint, dim int, ids binary, labels binary, vectors binary, low binary, high binary, least_label int, most_label int"
BLOCK_NAMES = [field.split()[0] for field in BLOCK.split(", ")]
PAGE = "page int, dim int, blocks binary, lows binary, highs binary, labels binary"
FOUND = "anchor_id bigint, window int, id bigint, score bigint"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (rows x dimensions, numbers below 2**bits) along the Hilbert curve, as rows of bytes that sort like it.

    From the highest bit down, a dimension whose bit is set turns the lower bits of the first dimension over, one whose bit is not set
    swaps them with those of the first; a Gray code of the turned bits, taken level by level, is the place.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for d in range(dims):
            upper = (x[d] >> level) & 1 > 0
            change = np.where(upper, 0, (x[0] ^ x[d]) & below)
            x[0] ^= np.where(upper, below, change)
            x[d] ^= change
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 > 0, (1 << level) - 1, 0)
    x ^= turn
    planes = [((x >> level) & 1).astype(np.uint8) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def matrix(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).reshape(-1, dim) if dim else np.zeros((0, 0), np.int32)


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of x with those of y."""
    most = [int(np.abs(v).max(initial=0)) for v in (x, y)]
    kind = np.float64 if most[0] * most[1] * max(1, x.shape[1]) < 1 << 53 else np.int64
    return (x.astype(kind) @ y.astype(kind).T).astype(np.int64)


def prepared(rows: DataFrame) -> DataFrame:
    """id, label, dim, the vector as 32-bit numbers in a binary column, and its greatest absolute component; one row an id."""
    whole = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), F.col("vector").cast("array<bigint>").alias("vector"))
    whole = whole.where("id is not null and label is not null and vector is not null and not exists(vector, x -> x is null)")
    if not whole.groupBy("id").count().where("count > 1").isEmpty():
        whole = whole.groupBy("id").agg(F.max(F.struct("label", "vector")).alias("row")).select("id", "row.*")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            values = np.clip(lists.flatten().to_numpy(), -MOST, MOST).astype(np.int32)
            lengths = lists.value_lengths().to_numpy()
            ends = np.cumsum(lengths)
            parts = [values[e - n : e] for n, e in zip(lengths.tolist(), ends.tolist(), strict=True)]
            most = [int(np.abs(p).max(initial=0)) for p in parts]
            columns = [batch.column("id"), batch.column("label"), pa.array(lengths, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(most, pa.int32())], ["id", "label", "dim", "vector", "most"])

    return whole.mapInArrow(pack, "id bigint, label int, dim int, vector binary, most int")


def blocks_of(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` (of ``prepared``) as blocks along the curve. Equal vectors are dealt out by id, so a vector that fills a third of the table is many blocks."""
    total, most = rows.agg(F.count("*"), F.max("most")).first()
    scale = max(1, most or 0)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            keys: list[bytes] = [b""] * len(dims)
            for dim in np.unique(dims[dims > 0]).tolist():
                at = np.flatnonzero(dims == dim)
                values = np.stack([np.frombuffer(batch.column("vector")[i].as_py(), np.int32) for i in at.tolist()]).astype(np.int64)
                cells = np.minimum(((values + scale) << BITS) // (2 * scale), (1 << BITS) - 1)
                for i, key in zip(at.tolist(), hilbert_keys(cells, BITS), strict=True):
                    keys[i] = key.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            ids, labels, dims, vectors = [batch.column(n).to_pylist() for n in ("id", "label", "dim", "vector")]
            for row in zip(dims, ids, labels, vectors, strict=True):
                if held and (len(held) == block_rows or held[0][0] != row[0]):
                    yield block(first, held)
                    first, held = first + 1, []
                held.append(row)
        if held:
            yield block(first, held)

    def block(number: int, held: list[tuple]) -> pa.RecordBatch:
        dim = held[0][0]
        labels = np.array([r[2] for r in held], np.int32)
        vectors = matrix(b"".join([r[3] for r in held]), dim) if dim else np.zeros((len(held), 0), np.int32)
        binary = [np.array([r[1] for r in held], np.int64), labels, vectors, vectors.min(axis=0), vectors.max(axis=0)]
        head = [pa.array([number], pa.int64()), pa.array([dim], pa.int32()), *[pa.array([b.tobytes()], pa.binary()) for b in binary]]
        return pa.RecordBatch.from_arrays([*head, pa.array([labels.min()], pa.int32()), pa.array([labels.max()], pa.int32())], BLOCK_NAMES)

    parts = max(1, -(-total // (block_rows * PARTITION_BLOCKS)))
    placed = rows.mapInArrow(keyed, "id bigint, label int, dim int, vector binary, most int, place binary")
    dealt = placed.repartitionByRange(parts, "dim", "place", "id").sortWithinPartitions("dim", "place", "id")
    return dealt.mapInArrow(cut, BLOCK)


def pages_of(blocks: DataFrame) -> DataFrame:
    """The zone maps of about ZONES blocks in a row."""
    count = blocks.count()
    page = F.pmod(F.xxhash64("block"), F.lit(max(1, -(-count // ZONES)))).cast("int")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and ((held[0]["page"], held[0]["dim"]) != (row["page"], row["dim"]) or len(held) == 4 * ZONES):
                    yield packed(held)
                    held = []
                held.append(row)
        if held:
            yield packed(held)

    def packed(held: list[dict]) -> pa.RecordBatch:
        numbers = np.array([r["block"] for r in held], np.int64).tobytes()
        labels = np.array([[r["least_label"], r["most_label"]] for r in held], np.int32).tobytes()
        binary = [numbers, b"".join([r["low"] for r in held]), b"".join([r["high"] for r in held]), labels]
        head = [pa.array([held[0]["page"]], pa.int32()), pa.array([held[0]["dim"]], pa.int32())]
        return pa.RecordBatch.from_arrays([*head, *[pa.array([b], pa.binary()) for b in binary]], ["page", "dim", "blocks", "lows", "highs", "labels"])

    zones = blocks.select(page.alias("page"), "dim", "block", "low", "high", "least_label", "most_label")
    return zones.repartition("page", "dim").sortWithinPartitions("page", "dim").mapInArrow(pack, PAGE)


class Wanted:
    """What the anchors of a tile look for. A window holds scores from ``floors`` to ``tops``; ``same`` says whether rows of the anchor's label count or the others."""

    def __init__(self, row: dict, same: bool):
        self.dim = row["dim"]
        self.anchors = np.frombuffer(row["anchors"], np.int64)
        self.labels = np.frombuffer(row["anchor_labels"], np.int32)
        vectors = np.frombuffer(row["anchor_vectors"], np.int32)
        self.vectors = vectors.reshape(len(self.anchors), self.dim)
        self.floors = np.frombuffer(row["floors"], np.int64).reshape(len(self.anchors), -1)
        self.tops = np.frombuffer(row["tops"], np.int64).reshape(len(self.anchors), -1)
        self.same = same

    def asks(self, lows: np.ndarray, highs: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """anchors x blocks: whether a block may hold a row that counts for some window of the anchor."""
        up, down = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        most = product(up, highs) + product(down, lows)
        least = product(up, lows) + product(down, highs)
        own = self.labels[:, None]
        fits = (labels[:, 0] <= own) & (own <= labels[:, 1]) if self.same else (labels[:, 0] != own) | (labels[:, 1] != own)
        met = np.zeros(most.shape, bool)
        for floor, top in zip(self.floors.T, self.tops.T, strict=True):
            met |= (most >= floor[:, None]) & (least <= top[:, None]) & (floor <= top)[:, None]
        return met & fits

    def best(self, chosen: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For each chosen anchor and window: anchor id, window, and ids and scores of the first k rows of the block that count."""
        scores = product(self.vectors[chosen], vectors)
        for i, a in enumerate(chosen.tolist()):
            count = (labels == self.labels[a]) == self.same
            count &= ids != self.anchors[a]
            for w, (floor, top) in enumerate(zip(self.floors[a].tolist(), self.tops[a].tolist(), strict=True)):
                at = np.flatnonzero(count & (scores[i] >= floor) & (scores[i] <= top))
                if len(at):
                    if len(at) > k:
                        at = at[scores[i][at] >= np.partition(scores[i][at], len(at) - k)[len(at) - k]]
                    at = at[np.lexsort((ids[at], -scores[i][at]))[:k]]
                    yield int(self.anchors[a]), w, ids[at], scores[i][at]


def found_batch(found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    sizes = [len(f[2]) for f in found]
    heads = [np.repeat(np.array([f[j] for f in found], np.int64), sizes) for j in (0, 1)]
    tails = [np.concatenate([f[j] for f in found]) if found else np.empty(0, np.int64) for j in (2, 3)]
    arrays = [pa.array(heads[0]), pa.array(heads[1].astype(np.int32)), *[pa.array(t) for t in tails]]
    return pa.RecordBatch.from_arrays(arrays, ["anchor_id", "window", "id", "score"])


def first_rows(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each anchor and window, with their rank; partial ranks come before the shuffle."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def in_own_block(blocks: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """The first rows of each anchor's windows within its own block; ``anchors`` has a row for each tile and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                wanted = Wanted(row, same)
                ids, labels, vectors = contents(row)
                yield found_batch(list(wanted.best(np.arange(len(wanted.anchors)), ids, labels, vectors, k)))

    return anchors.join(blocks.select("block", "ids", "labels", "vectors"), "block").mapInArrow(run, FOUND)


def contents(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int32)
    return ids, labels, np.frombuffer(row["vectors"], np.int32).reshape(len(ids), row["dim"])


def in_asked_blocks(blocks: DataFrame, pages: DataFrame, tiles: DataFrame, same: bool, k: int) -> DataFrame:
    """The first rows of each window in every block that its bounds leave; a tile meets each page of zone maps, then the blocks its anchors ask for."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                wanted = Wanted(row, same)
                numbers = np.frombuffer(row["blocks"], np.int64)
                shape = (len(numbers), wanted.dim)
                lows, highs = [np.frombuffer(row[n], np.int32).reshape(shape) for n in ("lows", "highs")]
                met = wanted.asks(lows, highs, np.frombuffer(row["labels"], np.int32).reshape(-1, 2))
                asked = np.flatnonzero(met.any(axis=0))
                who = [np.flatnonzero(met[:, j]).astype(np.int32) for j in asked.tolist()]
                head = [pa.array(np.full(len(asked), row["tile"], np.int64)), pa.array(np.full(len(asked), wanted.dim, np.int32))]
                arrays = [*head, pa.array(numbers[asked]), pa.array([w.tobytes() for w in who], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["tile", "dim", "block", "who"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                wanted = Wanted(row, same)
                ids, labels, vectors = contents(row)
                yield found_batch(list(wanted.best(np.frombuffer(row["who"], np.int32), ids, labels, vectors, k)))

    n_pages = (pages.agg(F.max("page")).first()[0] or 0) + 1
    paged = tiles.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1))))
    units = paged.join(pages, ["page", "dim"]).mapInArrow(ask, "tile bigint, dim int, block bigint, who binary")
    units = written(units, "units")
    met = units.join(tiles, ["tile", "dim"]).join(blocks.select("block", "ids", "labels", "vectors"), "block")
    return met.mapInArrow(read, FOUND)


def tiles_of(anchors: DataFrame, by: list[str]) -> DataFrame:
    """The anchors (anchor_id, label, vector, dim, block, floors, tops) of each key as arrays in binary columns; a key has a bounded number of blocks."""
    rows = anchors.groupBy(*by, "dim").agg(F.collect_list(F.struct("anchor_id", "label", "vector", "floors", "tops")).alias("rows"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column("rows").to_pylist():
                ids = np.array([r["anchor_id"] for r in row], np.int64)
                labels = np.array([r["label"] for r in row], np.int32)
                bounds = [np.array([r[n] for r in row], np.int64).tobytes() for n in ("floors", "tops")]
                out.append([ids.tobytes(), labels.tobytes(), b"".join([r["vector"] for r in row]), *bounds])
            binary = [pa.array([o[j] for o in out], pa.binary()) for j in range(5)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in [*by, "dim"]], *binary], [*by, "dim", *ARRAYS])

    schema = ", ".join([*[f"{n} bigint" for n in by], "dim int", *[f"{n} binary" for n in ARRAYS]])
    return rows.mapInArrow(pack, schema)


ARRAYS = ["anchors", "anchor_labels", "anchor_vectors", "floors", "tops"]


def round_of(blocks: DataFrame, pages: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """The first k rows of every window of ``anchors``: its own block raises the floors, then the blocks left are read."""
    own = in_own_block(blocks, tiles_of(anchors, ["block"]), same, k)
    reached = first_rows(own, k).where(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("reached"))
    raised = F.transform("floors", lambda f, i: F.coalesce(F.try_element_at("reached", i), f))
    known = anchors.join(reached, "anchor_id", "left").withColumn("floors", raised).drop("reached")
    tiles = written(tiles_of(known.withColumn("tile", F.shiftright("block", TILE_BLOCKS.bit_length() - 1)), ["tile"]), "tiles")
    return first_rows(in_asked_blocks(blocks, pages, tiles, same, k), k)


def mine(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score; ``rows`` has id, label and vector, ``anchors`` is a condition on id."""
    known = written(prepared(rows), "rows")
    blocks = written(blocks_of(known, block_rows), "blocks")
    pages = written(pages_of(blocks), "pages")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, vectors = contents(row)
                arrays = [pa.array(ids), pa.array(labels), pa.array([v.tobytes() for v in vectors], pa.binary())]
                head = [pa.array(np.full(len(ids), row["block"], np.int64)), pa.array(np.full(len(ids), row["dim"], np.int32))]
                yield pa.RecordBatch.from_arrays([*head, *arrays], ["block", "dim", "id", "label", "vector"])

    placed = blocks.select("block", "dim", "ids", "labels", "vectors").mapInArrow(chosen, "block bigint, dim int, id bigint, label int, vector binary")
    asked = written(placed.where(anchors).withColumnRenamed("id", "anchor_id"), "anchors")
    everything = F.array(F.lit(LEAST_SCORE)), F.array(F.lit(-LEAST_SCORE))
    found = round_of(blocks, pages, asked.withColumns({"floors": everything[0], "tops": everything[1]}), True, positives)
    best = written(found.select("anchor_id", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # The least and the greatest whole score of a window; a window of a score below 0 is empty.
    part = "cast(positive_score as decimal(30)) * {}"
    least, most = [part.format(percent) for percent in (low, high)]
    bounds = best.select("anchor_id", "rank", F.expr(f"({least} + pmod(-{least}, 100)) div 100").alias("floor"), F.expr(f"({most} - pmod({most}, 100)) div 100").alias("top"))
    windows = bounds.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "floor", "top"))).alias("found"))
    wanted = asked.join(windows, "anchor_id").withColumns({"floors": F.col("found.floor"), "tops": F.col("found.top")}).drop("found")
    hard = round_of(blocks, pages, written(wanted, "windows"), False, negatives)
    hard = hard.select("anchor_id", (F.col("window") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = best.withColumnRenamed("rank", "place").join(hard, ["anchor_id", "place"])
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
