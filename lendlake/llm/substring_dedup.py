"""Removal of word windows that also start in an earlier document.

A window is ``size`` consecutive words of one document. Its first document keeps it: a word is removed if a window
covers it whose word sequence also starts in a document with a smaller id. Windows are judged on the input.

First pass: a count-min sketch of the distinct windows of every document, merged over all partitions, overestimates
in how many documents a window stands. Second pass: the windows estimated repeated, and only these, are grouped exactly (96
hash bits) to find the first document of each. Windows below the sketch's hot count have few rows and are grouped in
one step; of the others, a task gathers the places of each and only these lists are shuffled, so no
task gathers a window that stands everywhere. Texts without a removal are not changed.

Null and empty texts have no words and keep none (the checksum of no bytes). A text below ``size`` words has no window. Rows of the same
id are one document for the comparison, and do not remove each other's windows. A row without an id is never changed and
never removes anything. Extra columns pass through ``deduplicate`` and are dropped by ``digest``; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlake.llm import sketch
from lendlake.llm.words import Words, slices
from lendlake.sources.scratch import written

SIZE = 50
PER_WORD = 6
GATHER_ROWS = 500_000
MOST_BROADCAST = 500_000
Finder = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
LISTED = "h1 bigint, doc_id bigint, key int, h2 bigint, starts array<int>"
FOUND = "h1 bigint, doc_id bigint, place bigint, key int"  # place: the other 32 hash bits, then the start


def with_key(docs: DataFrame) -> DataFrame:
    """Adds ``__key``, 31 bits of the text's hash that tell rows of the same id apart; 0 where all ids are different."""
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    key = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)) if repeated else F.lit(0)
    return docs.withColumn("__key", key.cast("int"))


def distinct_in_row(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Positions of the first occurrence of each hash in each row; rows are in order."""
    order = np.argsort(hashes, kind="stable")
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return order[new]


def sketched(docs: DataFrame, size: int) -> sketch.Sketch:
    words = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def hashes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in slices(batches):
            bounds = Words(batch.column("text"))
            at, hashes = bounds.windows(bounds.hashes(), size)
            yield hashes[distinct_in_row(bounds.rows[at], hashes)]

    return sketch.build(docs.select("text"), hashes_of, words // PER_WORD)


def repeats_finder(filters, size: int, hot: bool) -> Finder:
    """Gives start and hash of each window that the sketch takes for repeated: either the hot ones or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        estimate = filters.value
        for batch in slices(batches):
            bounds = Words(batch.column("text"))
            words = bounds.hashes()
            at, hashes = bounds.windows(words, size)
            found = estimate.repeated(hashes)
            found = found[estimate.is_hot(hashes[found]) == hot]
            at, hashes, rows = at[found], hashes[found], bounds.rows[at[found]]
            second = np.zeros(len(at), np.uint64)
            for j in range(size):
                second = second * np.uint64(0x9E3779B97F4A7C15) + words[at + j]
            place = (second >> np.uint64(32) << np.uint64(32)).view(np.int64) | (at - bounds.first[rows])
            doc_ids = batch.column("doc_id").take(pa.array(rows))
            key = batch.column("__key").take(pa.array(rows))
            arrays = [pa.array(hashes.view(np.int64)), doc_ids, pa.array(place), key]
            for start in range(0, len(at), 100_000):
                yield pa.RecordBatch.from_arrays([a.slice(start, 100_000) for a in arrays], ["h1", "doc_id", "place", "key"])

    return run


def lists_of_starts(find: Finder) -> Finder:
    """A row for each window and document of what ``find`` gives in a batch: h1, doc_id, key, h2 and the starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in find(batches):
            h1, place, key = (batch.column(c).to_numpy() for c in ("h1", "place", "key"))
            doc = batch.column("doc_id").to_numpy()
            h2, start = place >> 32, (place & 0xFFFFFFFF).astype(np.int32)
            order = np.lexsort((start, h2, h1, key, doc))
            h1, h2, doc, key, start = h1[order], h2[order], doc[order], key[order], start[order]
            differs = [a[1:] != a[:-1] for a in (doc, key, h1, h2)]
            new = np.flatnonzero(np.r_[True, np.logical_or.reduce(differs)]) if len(doc) else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[new, len(doc)].astype(np.int32)), pa.array(start))
            yield pa.RecordBatch.from_arrays([*[pa.array(v[new]) for v in (h1, doc, key, h2)], lists], ["h1", "doc_id", "key", "h2", "starts"])

    return run


def hot_starts(docs: DataFrame, find: Finder) -> DataFrame:
    """Later starts of hot windows, by document.

    A task first gathers its rows by window, so that a window that stands everywhere is one row per task with the list of its
    places; these lists, not the rows, meet the window's first document, and a task then deals them out by document.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in find(batches):
            held.append(batch)
            if sum(b.num_rows for b in held) >= GATHER_ROWS:
                yield gathered(held)
                held = []
        if held:
            yield gathered(held)

    def gathered(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        h1, doc, place, key = [table.column(i).to_numpy() for i in range(4)]
        order = np.lexsort((doc, place >> 32, h1))
        h1, doc, place, key = h1[order], doc[order], place[order], key[order].astype(np.int64)
        h2 = place >> 32
        place = key << 32 | (place & 0xFFFFFFFF)
        new = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        offsets = pa.array(np.r_[new, len(h1)].astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (doc, place)]
        return pa.RecordBatch.from_arrays([pa.array(h1[new]), pa.array(h2[new]), pa.array(doc[new]), *lists], names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, places = batch.column("docs"), batch.column("places")
            doc, place = docs.flatten().to_numpy(), places.flatten().to_numpy()
            first = np.repeat(batch.column("first_id").to_numpy(), docs.value_lengths().to_numpy())
            later = first < doc
            doc, place = doc[later], place[later]
            order = np.lexsort((place, doc))
            doc, key, start = doc[order], place[order] >> 32, (place[order] & 0xFFFFFFFF).astype(np.int32)
            new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]) if len(doc) else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[new, len(doc)].astype(np.int32)), pa.array(start))
            yield pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(key[new]), lists], ["doc_id", "key", "starts"])

    names = ["h1", "h2", "least", "docs", "places"]
    lists = written(docs.mapInArrow(gather, "h1 bigint, h2 bigint, least bigint, docs array<bigint>, places array<bigint>"), "hot_windows")
    first = written(lists.groupBy("h1", "h2").agg(F.min("least").alias("first_id")), "hot_first")
    if first.count() <= MOST_BROADCAST:  # then each list stays where its documents were read
        first = F.broadcast(first)
    met = lists.join(first, ["h1", "h2"]).select("first_id", "docs", "places")
    return met.mapInArrow(deal, "doc_id bigint, key bigint, starts array<int>")


def later_starts(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, key and the starts of all windows that also start in a document with a smaller id."""
    identified = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "__key")
    estimate = sketched(identified, size)
    filters = docs.sparkSession.sparkContext.broadcast(estimate)
    # One row per document, however often a window stands in it: below the hot count a window has few documents.
    few = identified.mapInArrow(lists_of_starts(repeats_finder(filters, size, hot=False)), LISTED)
    few = few.withColumn("first_id", F.min("doc_id").over(Window.partitionBy("h1", "h2"))).where("doc_id > first_id")
    later = few.groupBy("doc_id", F.col("key").cast("long").alias("key")).agg(F.flatten(F.collect_list("starts")).alias("starts"))
    if estimate.hot.any():
        parts = later.union(hot_starts(identified, repeats_finder(filters, size, hot=True)))
        later = parts.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    later = written(later, "starts")
    filters.destroy()
    return later


def removed_words(starts: list[int] | np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Which words the windows at ``starts`` cover."""
    change = np.zeros(n_words + 1, np.int32)
    np.add.at(change, starts, 1)
    np.subtract.at(change, np.asarray(starts) + size, 1)
    return np.cumsum(change[:-1]) > 0


def with_removals(docs: DataFrame, size: int, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``run`` over the rows of ``docs`` with the window starts to remove in ``__starts``.

    A bit map of a fixed size tells which ids may have removals. Only their rows are shuffled to meet them, by an exact join; the others go
    through ``run`` where they are read, with a null.
    """
    keyed = with_key(docs)
    starts = later_starts(keyed, size)
    ids = docs.sparkSession.sparkContext.broadcast(sketch.bit_map(starts.select("doc_id")))
    names = keyed.columns

    def possible(batch: pa.RecordBatch) -> np.ndarray:
        column = batch.column(names.index("doc_id"))
        return column.is_valid().to_numpy(zero_copy_only=False) & ids.value.has(pc.fill_null(column, 0).cast(pa.int64()).to_numpy())

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rest() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = batch.filter(pa.array(~possible(batch)))
                none = pa.nulls(kept.num_rows, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*kept.columns, none], [*names, "__starts"])

        return run(rest())

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(possible(batch)))

    found = keyed.mapInArrow(touched, keyed.schema).alias("d")
    cut = starts.select(F.col("doc_id").alias("__id"), F.col("key").alias("__k"), F.col("starts").alias("__starts"))
    met = found.join(cut, (F.col("d.doc_id") == F.col("__id")) & (F.col("d.__key") == F.col("__k")), "left").select("d.*", "__starts")
    return keyed.mapInArrow(untouched, schema).union(met.mapInArrow(run, schema))


def row_starts(batch: pa.RecordBatch, column: str, row: int) -> np.ndarray:
    value = batch.column(column)[row]
    return np.asarray(value.values) if value.is_valid else np.empty(0, np.int64)


def digest(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_removed, and the SHA-256 of the kept words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bounds = Words(batch.column("text"))
            raw = bounds.data.tobytes()
            removed, digests = [], []
            for row, (a, b) in enumerate(zip(bounds.first, bounds.first[1:], strict=False)):
                starts = row_starts(batch, "__starts", row)
                kept = np.arange(a, b)
                if len(starts):
                    kept = kept[~removed_words(starts, b - a, size)]
                spans = zip(bounds.starts[kept].tolist(), bounds.ends[kept].tolist(), strict=True)
                digests.append(hashlib.sha256(b" ".join([raw[i:j] for i, j in spans])).hexdigest())
                removed.append(b - a - len(kept))
            columns = [batch.column("doc_id"), pa.array(bounds.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_removals(rows, size, run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def deduplicate(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with the repeated windows cut out of their texts; a row left without any word is dropped.

    A cut goes from its first word to the next kept word; everything else stays byte for byte. n_chars, where there is
    such a column, is counted anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bounds = Words(batch.column("text"))
            raw, texts, keep = bounds.data.tobytes(), batch.column("text").to_pylist(), []
            for row, (a, b) in enumerate(zip(bounds.first, bounds.first[1:], strict=False)):
                starts = row_starts(batch, "__starts", row)
                keep.append(True)
                if not len(starts):
                    continue
                gone = removed_words(starts, b - a, size)
                keep[-1] = not gone.all()
                begins = np.append(bounds.starts[a:b], bounds.offsets[row + 1])
                kept = np.flatnonzero(~gone)
                lead = raw[bounds.offsets[row] : bounds.starts[a]]
                texts[row] = (lead + b"".join([raw[begins[i] : begins[i + 1]] for i in kept])).decode()
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    names = docs.columns
    cleaned = with_removals(docs, size, run, docs.schema)
    if "n_chars" in names:
        changed = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", changed)
    return cleaned
