"""Language-model scores from a log-frequency Bloom filter.

The model is a bigram model over words. Every bigram of the training part is counted by the hashes of its words, counts are quantised
downwards to the steps 1, 2, 3, 4, 6, 8, 12, 16, ..., and an n-gram of step q is put into a Bloom filter q times, with the numbers 1 to q. A query
probes 1, 2, ... until one is missing; the last one found gives the count. The probability of a word after another one is

    p(word | previous) = (count(previous, word) + MU * p(word)) / (total(previous) + MU + FALSE),

where ``total`` sums the quantised counts of all that follows the word, and FALSE is the expected number of words that the filter holds for
followers by mistake (its rate of false hits times the vocabulary). So the probabilities after a word add up to 1, up to the chance of false hits.
p(word) has one added to each count, for the COMMON most frequent words; all others, and a word never seen, share the rest
evenly. Their own counts decide only ``base_score``.

The filter comes in parts by the hash of the bigram. A part has BITS_PER_ENTRY bits for each of its entries, whatever their number, and there is a
part for each PART_TEXT bytes of training text. As many parts as fit into GROUP_BYTES are broadcast together; the texts are scored
against one group after the other, and each adds the terms of its own bigrams to a text's score. A small corpus has one group. The scores do not
depend on the groups.

Word counts are exact: a word occurs as often as it precedes another token. Those of common words are broadcast. The other words
of each document are joined to the counts.

A null or empty text is its end token. Rows are scored one by one, so repeated rows and ids get equal scores. The common words
are those above a count, so words of equal frequency are common together. Without training rows all counts are zero. Extra columns are
dropped; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.llm.words import Words, mix, slices
from lendlake.sources.scratch import written

COMMON = 1 << 18
MU = 200.0
PROBES = 8
CHECKED = 2
BITS_PER_ENTRY = 16
PART_TEXT = 32 << 20
GROUP_BYTES = 64 << 20
HELD = 4_000_000
PACKED = 1 << 16
END_HASH = np.uint64(0x0E0D)
STEPS = np.array(sorted({*(1 << k for k in range(62)), *(3 << k for k in range(60))}), np.int64)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased words with one end after each row's, and the end positions."""
    words = Words(column)
    counts = words.counts
    ends = np.cumsum(counts + 1) - 1
    out = np.full(int(counts.sum()) + len(counts), END_HASH, np.uint64)
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside] = words.hashes(lower=True)
    return out, ends


class CountFilter:
    """Log-frequency Bloom filter: quantised counts of integer keys."""

    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.bits = bits
        self.data = np.zeros(-(-bits // 8), np.uint8) if data is None else data

    @staticmethod
    def level(counts: np.ndarray) -> np.ndarray:
        return np.searchsorted(STEPS, counts, "right")

    @staticmethod
    def count(levels: np.ndarray) -> np.ndarray:
        """The least count of a level."""
        return np.where(levels > 0, STEPS[np.maximum(levels, 1) - 1], 0)

    @classmethod
    def of(cls, keys: np.ndarray, levels: np.ndarray) -> CountFilter:
        """The filter of all keys, sized by their entries."""
        own = cls(max(64, int(levels.sum()) * BITS_PER_ENTRY))
        flags = np.zeros(8 * len(own.data), bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            keys, levels = keys[levels >= level], levels[levels >= level]
            for cell in own.cells(keys, level):
                flags[cell] = True
        own.data = np.packbits(flags, bitorder="little")
        return own

    def cells(self, keys: np.ndarray, level: int) -> Iterator[np.ndarray]:
        first = mix(keys ^ mix(np.array([level], np.uint64)))
        step = mix(first)
        for i in range(PROBES):
            yield self.cell(first, step, i)

    def cell(self, first: np.ndarray, step: np.ndarray, i: int) -> np.ndarray:
        """Cell of the i-th probe: the upper half of a 64-bit hash, scaled to the size."""
        return (((first + np.uint64(i) * step) >> np.uint64(32)) * np.uint64(self.bits)) >> np.uint64(32)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Estimated counts by repeated probes; never less than what was put in."""
        return FilterGroup({0: self}).lookup(keys, np.array([0, len(keys)]))

    def false_hits(self) -> float:
        """Share of keys never put in that are found."""
        return float(np.bitwise_count(self.data).sum() / self.bits) ** PROBES


class FilterGroup:
    """The filters of parts that follow each other, in one array."""

    def __init__(self, filters: dict[int, CountFilter]):
        self.lowest = min(filters)
        own = [filters[part] for part in sorted(filters)]
        self.bits = np.array([f.bits for f in own], np.uint64)
        self.base = np.cumsum([0, *[len(f.data) for f in own[:-1]]]).astype(np.uint64)
        self.data = np.concatenate([f.data for f in own])

    def __len__(self) -> int:
        return len(self.bits)

    def lookup(self, keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Estimated counts of keys that come part by part, those of the i-th from ``bounds[i]`` to ``bounds[i + 1]``.

        All are probed together, so that many short runs of keys cost no more than a long one.
        """
        sizes = np.diff(bounds)
        return CountFilter.count(levels_in(self.data, np.repeat(self.base, sizes), np.repeat(self.bits, sizes), keys))


def levels_in(data: np.ndarray, base: np.ndarray, bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The last level of each key whose probes all hit, in a filter of ``bits`` bits from byte ``base``.

    Keys that miss are left out after the first CHECKED probes of a level and after its last: most of the others pass them all.
    """
    levels = np.zeros(len(keys), np.int64)
    live, level = np.arange(len(keys)), 1
    while len(live) and level <= len(STEPS):
        at = mix(keys ^ mix(np.array([level], np.uint64)))
        step = mix(at)
        for probes in (CHECKED, PROBES - CHECKED):
            hit = np.full(len(at), 1, np.uint8)
            for _ in range(probes):
                cell = ((at >> np.uint64(32)) * bits) >> np.uint64(32)
                hit &= data[base + (cell >> np.uint64(3))] >> (cell.astype(np.uint8) & np.uint8(7))
                at += step
            kept = np.flatnonzero(hit)
            if len(kept) < len(hit):
                live, keys, base, bits, at, step = (a[kept] for a in (live, keys, base, bits, at, step))
        levels[live] = level
        level += 1
    return levels


def bigrams(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Key of each pair of word hashes."""
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + words)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)


def following_end(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The token before each one; a text begins after an end."""
    before = np.r_[END_HASH, hashes[:-1]]
    before[ends[:-1] + 1] = END_HASH
    return before


@dataclass
class Model:
    """What is broadcast beside the filter: counts of the common words, sorted by hash, and the totals of what follows them."""

    total: int
    distinct: int
    common: np.ndarray
    common_counts: np.ndarray
    common_totals: np.ndarray
    parts: int
    false_hits: float

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the common words, and which hashes are there."""
        if not len(self.common):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        shift, begin, ordered = self.index
        at = begin[hashes >> shift]
        live = np.flatnonzero(ordered[at] < hashes)
        while len(live):
            at[live] += 1
            live = live[ordered[at[live]] < hashes[live]]
        at = np.minimum(at, len(self.common) - 1)
        return at, self.common[at] == hashes

    @cached_property
    def index(self) -> tuple[np.uint64, np.ndarray, np.ndarray]:
        """Where the hashes with the same upper bits begin among the common words, about one for each; and these words with an end."""
        upper = len(self.common).bit_length()
        shift = np.uint64(64 - upper)
        begin = np.searchsorted(self.common, np.arange(1 << upper, dtype=np.uint64) << shift)
        return shift, begin, np.r_[self.common, ~np.uint64(0)]

    def fallback(self, at: np.ndarray, known: np.ndarray) -> np.ndarray:
        """MU * p(word)."""
        others = self.distinct - len(self.common)
        rest = (self.total - int(self.common_counts.sum()) + others + 1) / (others + 1)
        n = np.full(len(at), rest)
        n[known] = self.common_counts[at[known]] + 1
        return MU * n / (self.total + self.distinct + 1)

    @property
    def spare(self) -> float:
        """What a context's total is short of the denominator."""
        return MU + self.false_hits * (self.distinct + 1)


def counted_bigrams(docs: DataFrame, parts: int) -> DataFrame:
    """All pairs of tokens that follow each other, counted per batch and sent to their part in rows of at most PACKED pairs.

    A row has its part, the keys, their counts, and the words before: each word once, with the number of its keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in slices(batches):
            hashes, ends = tokens(batch.column("text"))
            held.append(np.stack([following_end(hashes, ends), hashes]))
            if sum(h.shape[1] for h in held) > HELD:
                yield from counted(held)
                held = []
        if held:
            yield from counted(held)

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        before, words = np.concatenate(held, axis=1)
        held.clear()
        keys, first, n = np.unique(bigrams(before, words), return_index=True, return_counts=True)
        before, part = before[first], part_of(keys, parts)
        order = np.lexsort((before, part))
        keys, before, n, part = keys[order], before[order], n[order].astype(np.uint32), part[order]
        bounds = np.searchsorted(part, np.arange(parts + 1))
        for place, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            for start in range(low, high, PACKED):
                stop = min(start + PACKED, high)
                own = before[start:stop]
                new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                runs = np.diff(np.r_[new, len(own)]).astype(np.uint32)
                cells = [a.tobytes() for a in (keys[start:stop], n[start:stop], own[new], runs)]
                arrays = [pa.array([place], pa.int32()), *[pa.array([cell], pa.binary()) for cell in cells]]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "keys", "counts", "words", "runs"])

    rows = docs.select("text").mapInArrow(run, "part int, keys binary, counts binary, words binary, runs binary")
    return rows.repartition(parts, "part")


def filter_parts(counts: DataFrame) -> DataFrame:
    """From the rows of ``counted_bigrams``: each part's filter (part, bits, data, false_hits), and partial n and quantised total of the words before.

    A part is summed as a whole; it comes from about PART_TEXT bytes of text, whatever the size of the corpus.
    """
    names = ["part", "bits", "data", "false_hits", "before", "n", "total"]
    schema = "part int, bits bigint, data binary, false_hits double, before bigint, n bigint, total bigint"

    def batch_of(**given: pa.Array) -> pa.RecordBatch:
        size = len(next(iter(given.values())))
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([given[c].cast(t) if c in given else pa.nulls(size, t) for c, t in zip(names, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.column("part")[row].as_py()
                if part != current and held:
                    yield from built(current, held)
                    held = []
                current = part
                cells = zip(("keys", "counts", "words", "runs"), (np.uint64, np.uint32, np.uint64, np.uint32), strict=True)
                held.append([np.frombuffer(batch.column(c)[row].as_py(), kind) for c, kind in cells])
        if held:
            yield from built(current, held)

    def built(part: int, held: list) -> Iterator[pa.RecordBatch]:
        keys, counts = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        before = np.concatenate([np.repeat(h[2], h[3]) for h in held])
        held.clear()
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, n, before = keys[new], np.add.reduceat(counts[order].astype(np.int64), new), before[order[new]]
        levels = CountFilter.level(n)
        own = CountFilter.of(keys, levels.astype(np.uint8))
        sent = {"part": pa.array([int(part)]), "bits": pa.array([own.bits]), "data": pa.array([own.data.tobytes()], pa.binary())}
        yield batch_of(**sent, false_hits=pa.array([own.false_hits()]))
        order = np.argsort(before)
        before = before[order]
        new = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        sums = [np.add.reduceat(v[order], new) for v in (n, CountFilter.count(levels))]
        words = before[new].view(np.int64)
        for start in range(0, len(words), PACKED):
            some = slice(start, start + PACKED)
            yield batch_of(before=pa.array(words[some]), n=pa.array(sums[0][some]), total=pa.array(sums[1][some]))

    return counts.sortWithinPartitions("part").mapInArrow(run, schema)


def least_common_level(counts: DataFrame, most: int) -> int | None:
    """The least level, on a logarithmic scale of counts, such that at most ``most`` words reach it; None if the highest has more."""
    sizes = counts.groupBy(count_level().alias("level")).count().collect()  # at most a thousand levels
    kept, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        kept += row["count"]
        if kept > most:
            break
        least = row["level"]
    return least


def count_level() -> Column:
    return F.floor(16 * F.log2("n"))


def learn(docs: DataFrame, common: int = COMMON, part_text: int = PART_TEXT) -> tuple[Model, DataFrame, DataFrame]:
    """The model of ``docs`` (text), the table of its filter's parts, and the exact counts and totals of all words."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_text))
    built = written(filter_parts(counted_bigrams(docs, parts)), "filter")
    words = built.where(F.col("before").isNotNull()).groupBy(F.col("before").alias("hash"))
    counts = written(words.agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "word_counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = least_common_level(counts, common)
    top = counts.where(F.lit(False) if least is None else count_level() >= least).toPandas()
    hashes = top["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    n, totals = (top[c].to_numpy(np.int64)[order] for c in ("n", "total"))
    filters = built.where(F.col("part").isNotNull()).select("part", "bits", "data", "false_hits")
    wrong = filters.agg(F.avg("false_hits")).first()[0] or 0.0
    return Model(total, distinct, hashes[order], n, totals, parts, wrong), filters, counts


def groups_of(filters: DataFrame, parts: int, group_bytes: int) -> Iterator[dict[int, CountFilter]]:
    """The parts of the filter in groups of at most ``group_bytes``, one part at least; a part without bigrams is empty."""
    sizes = {r["part"]: r["size"] for r in filters.select("part", F.octet_length("data").alias("size")).toLocalIterator()}
    group: list[int] = []
    for part in range(parts):
        if group and sum(sizes.get(p, 0) for p in group) + sizes.get(part, 0) > group_bytes:
            yield gathered(filters, group)
            group = []
        group.append(part)
    yield gathered(filters, group)


def gathered(filters: DataFrame, group: list[int]) -> dict[int, CountFilter]:
    found = {p: CountFilter(64) for p in group}
    for row in filters.where(F.col("part").between(group[0], group[-1])).toLocalIterator():
        found[row["part"]] = CountFilter(row["bits"], np.frombuffer(row["data"], np.uint8))
    return found


TERMS = "key bigint, doc_id bigint, model double"
FIRST = "row bigint, n_tokens bigint, known bigint, base double, rare array<bigint>, times array<int>"


def terms(docs: DataFrame, shared, group, first: bool) -> DataFrame:
    """key, doc_id and the sum of the log10 terms of the group's bigrams for each text of ``docs`` (key, doc_id, text).

    The first group's rows also hold what needs no filter: the common words' part of ``base_score`` and of the denominators, and the other
    words with their numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, filters, row = shared.value, group.value, TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            hashes, ends = tokens(batch.column("text"))
            starts = np.r_[0, ends[:-1] + 1]
            keys = bigrams(following_end(hashes, ends), hashes)
            place = part_of(keys, own.parts) - filters.lowest
            mine = np.flatnonzero((place >= 0) & (place < len(filters)))
            mine = mine[np.argsort(place[mine], kind="stable")]
            bounds = np.searchsorted(place[mine], np.arange(len(filters) + 1))
            sought = hashes if first else hashes[mine]
            at, known = own.find(sought)
            each = np.zeros(len(hashes))
            each[mine] = own.fallback(at[mine], known[mine]) if first else own.fallback(at, known)
            uniques = [np.unique(keys[mine[low:high]], return_inverse=True) for low, high in zip(bounds[:-1], bounds[1:], strict=True)]
            edges = np.cumsum([0, *[len(unique) for unique, _ in uniques]])
            found = filters.lookup(np.concatenate([unique for unique, _ in uniques]), edges)
            each[mine] += found[np.concatenate([back + edge for (_, back), edge in zip(uniques, edges[:-1], strict=True)])]
            each[mine] = np.log10(each[mine])
            arrays = [batch.column("key"), batch.column("doc_id")]
            if not first:
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.add.reduceat(each, starts))], ["key", "doc_id", "model"])
                continue
            # The contexts of a text, the end before it and its words, are its tokens.
            each[known] -= np.log10(own.common_totals[at[known]] + own.spare)
            base = np.zeros(len(hashes))
            base[known] = np.log10((own.common_counts[at[known]] + 1) / (own.total + own.distinct + 1))
            owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[starts, len(hashes)]))
            others = np.flatnonzero(~known)
            order = np.lexsort((hashes[others], owner[others]))
            h, o = hashes[others][order], owner[others][order]
            new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])]) if len(h) else np.empty(0, np.int64)
            lists = pa.array(np.searchsorted(o[new], np.arange(len(ends) + 1)).astype(np.int32))
            arrays += [
                pa.array(np.add.reduceat(each, starts)),
                pa.array(row + np.arange(len(ends))),
                pa.array(np.diff(np.r_[starts, len(hashes)])),
                pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                pa.array(np.add.reduceat(base, starts)),
                pa.ListArray.from_arrays(lists, pa.array(h[new].view(np.int64))),
                pa.ListArray.from_arrays(lists, pa.array(np.diff(np.r_[new, len(h)]).astype(np.int32))),
            ]
            row += len(ends)
            yield pa.RecordBatch.from_arrays(arrays, ["key", "doc_id", "model", "row", "n_tokens", "known", "base", "rare", "times"])

    return docs.mapInArrow(run, f"{TERMS}, {FIRST}" if first else TERMS)


def score(docs: DataFrame, model: Model, filters: DataFrame, counts: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each text.

    Equal rows cannot be told apart between the groups; as they score alike, each gets the mean of their sums.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    docs = docs.select(F.xxhash64(doc_id, "text").alias("key"), doc_id, "text")
    shared, passes = docs.sparkSession.sparkContext.broadcast(model), []
    for filters_of_group in groups_of(filters, model.parts, group_bytes):
        group = docs.sparkSession.sparkContext.broadcast(FilterGroup(filters_of_group))
        passes.append(written(terms(docs, shared, group, not passes), "terms"))
        group.destroy()
    shared.destroy()
    rows = passes[0].withColumn("more", F.lit(0.0))
    if passes[1:]:
        later = passes[1]
        for each in passes[2:]:
            later = later.unionByName(each)
        sums = later.groupBy("key", "doc_id").agg((F.sum("model") * (len(passes) - 1) / F.count(F.lit(1))).alias("more"))
        same = (passes[0]["key"] == sums["key"]) & passes[0]["doc_id"].eqNullSafe(sums["doc_id"])
        rows = passes[0].join(sums, same).select(*[passes[0][c] for c in passes[0].columns], "more")
    rare = passes[0].select("row", F.explode(F.arrays_zip("rare", "times")).alias("word")).select("row", F.col("word.rare").alias("hash"), "word.times")
    found = rare.join(counts, "hash", "left").groupBy("row").agg(
        F.sum("times").alias("rare_tokens"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_logs"),
        F.sum(F.col("times") * F.log10(F.coalesce("total", F.lit(0)) + model.spare)).alias("rare_spare"),
    )
    both = rows.join(found, "row", "left").fillna(0, ["rare_tokens", "rare_known", "rare_logs", "rare_spare"])
    base = F.col("base") + F.col("rare_logs") - F.col("rare_tokens") * F.log10(F.lit(float(model.total + model.distinct + 1)))
    return both.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.col("rare_known")).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("model") + F.col("more") - F.col("rare_spare")).alias("score"),
    )
