"""Lines that stand in many documents stay in one of them: sharded minimal perfect hashes instead of a join of lines.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower case. A key of at least ``least_chars`` code points that
is found in at least ``min_docs`` documents loses its lines in all of them but the one with the largest id. Lines end at ``\\n``.

Keys are 128-bit hashes. Tasks add up their own documents first; sums give each repeated key its number of documents and its largest id.
The repeated keys go into an index of minimal perfect hashes (``perfect_hash``): bits, a 64-bit fingerprint, a count and the keeping document for each.
Documents probe these arrays. The keys that the most documents hold, MOST_BROADCAST at most (about 25 MB), are broadcast and probed where
a document is read. If there are more, the hashes of a document's other lines go to the shards of the remaining index, are probed
there, and only the hits go back to their document. A key outside the broadcast part stands in a small share of the documents by construction, so no shard is
hot; both parts give the same answers, and no key is left out.

A null or empty text is one empty line. Rows of the same id are one document, and if it keeps a line all its rows do. A row without an id counts
for nothing and is never changed. Extra columns pass through ``deduplicate`` and are dropped by ``digest``; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.perfect_hash import NAMES, SHARD, Index, shard_bits, shards
from lendlake.llm.substring_dedup import with_key
from lendlake.llm.words import slices
from lendlake.sources.scratch import written

MIN_DOCS = 3
LEAST_CHARS = 20
MOST_BROADCAST = 1 << 20
HELD_KEYS = 500_000
BLANK = b" \t\n\x0b\x0c\r"
FOUND = "h1 bigint, h2 bigint, n bigint, keeper bigint"
PROBE = "shard int, kind int, h1 bigint, h2 bigint, doc_id bigint, key int"


def hashed(line: bytes, least_chars: int) -> bytes | None:
    """The hash of a line's key, None if the key is too short to count."""
    key = line.strip(BLANK)
    if len(key) < least_chars or (len(key) < 4 * least_chars and len(key.decode()) < least_chars):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()  # lower() of bytes changes A-Z only


def split_lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def occurrences(least_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each distinct key of the rows a task holds, with its number of rows and the largest id."""

    def added(hashes: list[bytes], doc_ids: list[int]) -> pa.RecordBatch:
        (high, low), ids = halves(hashes), np.array(doc_ids, np.int64)
        order = np.lexsort((ids, low, high))
        high, low, ids = high[order], low[order], ids[order]
        new = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        ends = np.r_[new[1:], len(ids)]
        columns = [high[new].view(np.int64), low[new].view(np.int64), ends - new, ids[ends - 1]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h1", "h2", "n", "keeper"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids = [], []
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = {h for h in [hashed(line, least_chars) for line in split_lines(text)] if h}
                hashes.extend(own)
                ids.extend([doc_id] * len(own))
            if len(hashes) >= HELD_KEYS:
                yield added(hashes, ids)
                hashes, ids = [], []
        if hashes:
            yield added(hashes, ids)

    return run


def repeated_keys(docs: DataFrame, min_docs: int, least_chars: int) -> DataFrame:
    """h1, h2, n and keeper of each key in ``min_docs`` documents or more."""
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        found = docs.mapInArrow(occurrences(least_chars), FOUND)
    else:  # rows of one id count once for a key
        found = docs.mapInArrow(one_by_one(least_chars), FOUND).distinct()
    total = found.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))
    return total.where(F.col("n") >= min_docs)


def one_by_one(least_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """As ``occurrences``, a row for each key of each document."""
    gather = occurrences(least_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for i in range(batch.num_rows):
                yield from gather(iter([batch.slice(i, 1)]))

    return run


def indexed(keys: DataFrame, bits: int) -> DataFrame:
    """One row for each shard of the keys' index."""
    shard = F.shiftrightunsigned("h1", 64 - bits).cast("int").alias("shard")
    dealt = keys.select(shard, "h1", "h2", "n", "keeper").repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(shards, SHARD)


class LineIndex:
    """The index of the repeated keys: the broadcast part, and the shards of the rest, None if there is no rest."""

    def __init__(self, hot: Broadcast, cold: DataFrame | None, cold_bits: int):
        self.hot = hot
        self.cold = cold
        self.cold_bits = cold_bits


def line_index(docs: DataFrame, min_docs: int = MIN_DOCS, least_chars: int = LEAST_CHARS, most_broadcast: int = MOST_BROADCAST) -> LineIndex:
    """The index of all keys that ``min_docs`` documents or more hold; ``docs`` has doc_id and text."""
    keys = written(repeated_keys(docs.where("doc_id is not null"), min_docs, least_chars), "lines")
    grade = F.floor(F.log2("n") * 8).cast("int")
    by_grade = sorted(keys.groupBy(grade.alias("grade")).count().collect(), reverse=True)
    total, hot_keys, least_grade = sum(r["count"] for r in by_grade), 0, 1 << 30
    for row in by_grade:
        if hot_keys + row["count"] > most_broadcast:
            break
        hot_keys, least_grade = hot_keys + row["count"], row["grade"]
    bits = shard_bits(hot_keys)
    rows = [r.asDict() for r in indexed(keys.where(grade >= least_grade), bits).toLocalIterator()]
    hot = docs.sparkSession.sparkContext.broadcast(Index(bits, rows))
    if hot_keys == total:
        return LineIndex(hot, None, 0)
    bits = shard_bits(total - hot_keys)
    return LineIndex(hot, written(indexed(keys.where(grade < least_grade), bits), "line_index"), bits)


def cold_hits(docs: DataFrame, index: LineIndex, least_chars: int) -> DataFrame:
    """doc_id, key and the hashes of the lines that the index beyond the broadcast part drops from them."""
    bits = index.cold_bits
    hot = index.hot

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, rows = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = {h for h in [hashed(line, least_chars) for line in split_lines(text)] if h}
                hashes.extend(own)
                rows.extend([row] * len(own))
            high, low = halves(hashes)
            cold = np.flatnonzero(hot.value.find(high, low) < 0)
            high, low, rows = high[cold], low[cold], pa.array(np.array(rows, np.int64)[cold])
            shard = (high >> np.uint64(64 - bits)).astype(np.int32)
            ids = [batch.column("doc_id").take(rows), batch.column("__key").take(rows)]
            arrays = [pa.array(shard), pa.array(np.ones(len(shard), np.int32)), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), *ids]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", "kind", "h1", "h2", "doc_id", "key"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, -1
        for batch in batches:
            shard, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            bounds = [0, *(np.flatnonzero((np.diff(shard) != 0) | (kind[1:] == 0) | (kind[:-1] == 0)) + 1).tolist(), len(shard)]
            for start, stop in zip(bounds, bounds[1:], strict=False):
                part = batch.slice(start, stop - start)
                if start < stop and kind[start] == 0:
                    row = {name: part.column(name)[0].as_py() for name in NAMES}
                    held, number = Index(bits, [row]), int(shard[start])
                elif start < stop and shard[start] == number:
                    high, low = [part.column(n).to_numpy().view(np.uint64) for n in ("h1", "h2")]
                    place = held.find(high, low)
                    found = np.flatnonzero(place >= 0)
                    found = found[held.keepers[place[found]] != part.column("doc_id").to_numpy()[found]]
                    hits = part.take(pa.array(found))
                    yield pa.RecordBatch.from_arrays([hits.column(n) for n in ("doc_id", "key", "h1")], ["doc_id", "key", "h1"])

    asked = docs.where("doc_id is not null").mapInArrow(ask, PROBE)
    both = index.cold.withColumn("kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    hits = both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(probe, "doc_id bigint, key int, h1 bigint")
    return hits.groupBy("doc_id", "key").agg(F.collect_set("h1").alias("lines"))


def free_name(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


Judge = Callable[[pa.RecordBatch], tuple[list[list[bytes]], list[np.ndarray]]]


def judged(docs: DataFrame, min_docs: int, least_chars: int, most_broadcast: int) -> tuple[DataFrame, Judge]:
    """Documents with what the rest of the index drops from them, and a function giving lines and dropped lines of a batch of them."""
    rest = free_name("lines", docs)
    own = with_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    index = line_index(own, min_docs, least_chars, most_broadcast)
    if index.cold is None:
        rows = docs.withColumn(rest, F.lit(None).cast("array<bigint>"))
    else:
        one_key = own.where("__key <> 0").isEmpty()
        key = F.lit(0) if one_key else F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
        hits = cold_hits(own, index, least_chars).select(F.struct("doc_id", "key").alias("__of"), F.col("lines").alias("__cut"))
        left, right = docs.select(F.struct("*").alias("__row"), F.struct(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key")).alias("__at")), hits
        rows = left.join(right, F.col("__at") == F.col("__of"), "left").select("__row.*", F.col("__cut").alias(rest))
    hot = index.hot

    def judge(batch: pa.RecordBatch) -> tuple[list[list[bytes]], list[np.ndarray]]:
        texts = [split_lines(text) for text in batch.column("text").to_pylist()]
        hashes = [hashed(line, least_chars) for lines in texts for line in lines]
        at = np.array([i for i, h in enumerate(hashes) if h], np.int64)
        high, low = halves([h for h in hashes if h])
        counts = np.array([len(lines) for lines in texts])
        rows = np.repeat(np.arange(len(texts)), counts)[at]
        valid = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column("doc_id").fill_null(0).cast(pa.int64()).to_numpy()
        place = hot.value.find(high, low)
        found = np.flatnonzero(place >= 0)
        found = found[(hot.value.keepers[place[found]] != ids[rows[found]]) & valid[rows[found]]]
        dropped = np.zeros(len(hashes), bool)
        dropped[at[found]] = True
        for row, lines in enumerate(batch.column(rest).to_pylist()):
            if lines:
                mine = np.flatnonzero(rows == row)
                dropped[at[mine[np.isin(high[mine].view(np.int64), lines)]]] = True
        return texts, np.split(dropped, np.cumsum(counts)[:-1])

    return rows, judge


def digest(docs: DataFrame, min_docs: int = MIN_DOCS, least_chars: int = LEAST_CHARS, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """doc_id, n_lines, n_dropped, and the SHA-256 of the lines that stay, joined by ``\\n``."""
    rows, judge = judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), min_docs, least_chars, most_broadcast)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, dropped = judge(batch)
            digests = []
            for lines, gone in zip(texts, dropped, strict=True):
                kept = [line for line, g in zip(lines, gone.tolist(), strict=True) if not g] if gone.any() else lines
                digests.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
            numbers = [pa.array([f(x) for x in dropped], pa.int64()) for f in (len, lambda x: int(x.sum()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *numbers, pa.array(digests, pa.string())], names)

    names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    return rows.mapInArrow(run, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")


def deduplicate(docs: DataFrame, min_docs: int = MIN_DOCS, least_chars: int = LEAST_CHARS, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``docs`` with the lines dropped from their texts; texts without a dropped line, nulls too, stay as they are."""
    rows, judge = judged(docs, min_docs, least_chars, most_broadcast)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            for row, (lines, gone) in enumerate(zip(*judge(batch), strict=True)):
                if gone.any():
                    texts[row] = b"\n".join([line for line, g in zip(lines, gone.tolist(), strict=True) if not g]).decode()
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, docs.schema)
