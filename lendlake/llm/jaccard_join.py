"""Near-duplicate documents by the Jaccard similarity of their word shingles, with adaptive multi-match prefixes.

A document's set is its distinct shingles of ``words`` words after A-Z are lower-cased; a text with fewer words has one element, all of
them. Documents link when 100 * intersection >= ``percent`` * union.

1. Documents of equal sets form one class, so copies are compared once. A frequency table of all shingles is added up.
2. A class's elements are put in one global order, rare ones first. Linked sets of n elements share all but ``slack`` = n - ceil(percent * n / 100)
   of them, so their prefixes of slack + l elements share l or more. Each class picks its own l: a longer prefix costs more, but
   a pair must then share more of it; l is where the length plus the estimated candidates (the frequencies of the prefix over
   l) is least. Classes meet at an element of both base prefixes (slack + 1) that is early enough in both to be their first common one. A pair
   is verified if its prefixes share min(l, l') elements and what is left behind the shorter prefix can still reach the overlap. This
   loses no link.
3. Candidates meet in two rounds, so that a large group of near copies does not become all its pairs: first every class and the foremost
   class of each shared element; these are verified and joined to components. Then only pairs across components are compared.
4. Verification intersects the full sets.

Sets, signatures and order use 64 hash bits per shingle (56 in the order), class signatures 128. A null or empty text has an empty set and links with nothing.
Rows of equal ids are different rows; a row without an id can connect others but is nobody's component id. Extra columns are
not used. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.llm.components import connected
from lendlake.llm.sketch import bit_map
from lendlake.llm.words import PATTERN, Words, mix, slices
from lendlake.sources.scratch import written

WORDS = 5
PERCENT = 80
MOST_MATCHES = 8
TABLE_BITS = 20
SLICE_BITS = 14
MOST_HELD = 1 << 31
SIGNATURE = ["n", "s1", "s2"]


def shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, in order of row and hash, and the number of each row's."""
    words = Words(column)
    hashes = words.hashes(lower=True)
    at, full = words.windows(hashes, size)
    rows = words.rows[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        whole = []
        for row in short:
            value = np.uint64(0)
            for h in hashes[words.first[row] : words.first[row + 1]]:
                value = mix(np.array([value ^ h]))[0]
            whole.append(value)
        rows, full = np.concatenate([rows, short]), np.concatenate([full, np.array(whole, np.uint64)])
    rows, full = in_order(rows, full)
    new = np.ones(len(full), bool)
    new[1:] = (full[1:] != full[:-1]) | (rows[1:] != rows[:-1])
    rows, full = rows[new], full[new]
    return rows, full, np.bincount(rows, minlength=len(column))


def in_order(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by row, then key."""
    order = np.argsort(keys)
    small = rows[order].astype(np.uint16) if rows.max(initial=0) < 65536 else rows[order]
    order = order[np.argsort(small, kind="stable")]
    return rows[order], keys[order]


def signatures(rows: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums of mixed hashes for each row's set."""
    ends = np.cumsum(counts)
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)))])
        out.append((sums[ends] - sums[ends - counts]).view(np.int64))
    return out[0], out[1]


PROFILE = "doc_id bigint, n bigint, s1 bigint, s2 bigint, slice int, data binary"


def profiles(docs: DataFrame, size: int) -> DataFrame:
    """A row per document with its set's size and signature, and rows that hold slices of the frequency table."""

    def table(counts: np.ndarray) -> pa.RecordBatch:
        parts = counts.astype(np.uint32).reshape(-1, 1 << SLICE_BITS)
        none = pa.nulls(len(parts), pa.int64())
        data = pa.array([row.tobytes() for row in parts], pa.binary())
        return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(np.arange(len(parts), dtype=np.int32)), data], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = 0, np.zeros(1 << TABLE_BITS, np.int64)
        for batch in slices(batches):
            rows, hashes, counts = shingles(batch.column("text"), size)
            s1, s2 = signatures(rows, hashes, counts)
            none = [pa.nulls(len(counts), pa.int32()), pa.nulls(len(counts), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), pa.array(s1), pa.array(s2), *none], names)
            total += np.bincount((hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64), minlength=len(total))
            held += len(hashes)
            if held >= MOST_HELD:
                yield table(total)
                held, total = 0, np.zeros_like(total)
        if held:
            yield table(total)

    names = [c.split(" ")[0] for c in PROFILE.split(", ")]
    return docs.mapInArrow(run, PROFILE)


def frequency_table(profile: DataFrame) -> np.ndarray:
    """Occurrences of all shingles by the top bits of their hash; 2**TABLE_BITS numbers at any size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(data, np.uint32).astype(np.int64)
                sums[i] = sums[i] + part if i in sums else part
        for i, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "data"])

    parts = profile.where("slice is not null").select("slice", "data").repartition("slice")
    out = np.zeros((1 << (TABLE_BITS - SLICE_BITS), 1 << SLICE_BITS), np.int64)
    for row in parts.mapInArrow(add, "slice int, data binary").collect():
        out[row["slice"]] = np.frombuffer(bytes(row["data"]), np.int64)
    return out.ravel()


def prefixes(docs: DataFrame, table, size: int, percent: int) -> DataFrame:
    """Signature, l and prefix elements, in order, of each document with a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = table.value
        noise = raw.mean()
        frequent = np.maximum(0.0, raw - noise - 3 * np.sqrt(noise) - 1)
        rank = np.minimum(255, np.floor(8 * np.log2(raw + 1))).astype(np.uint64)
        for batch in slices(batches):
            rows, hashes, counts = shingles(batch.column("text"), size)
            s1, s2 = signatures(rows, hashes, counts)
            cell = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            # The elements of a rank are ordered by the low bits of their hash.
            keys = rank[cell] << np.uint64(56) | (hashes & np.uint64((1 << 56) - 1))
            order = np.argsort(keys)
            small = rows[order].astype(np.uint16) if len(counts) < 65536 else rows[order]
            order = order[np.argsort(small, kind="stable")]
            keys, cost = keys[order], np.concatenate([[0.0], np.cumsum(frequent[cell[order]])])
            ends = np.cumsum(counts)
            starts = ends - counts
            slack = counts - -(-percent * counts // 100)
            best, matches = np.full(len(counts), np.inf), np.zeros(len(counts), np.int64)
            for m in range(1, MOST_MATCHES + 1):
                length = slack + m
                fits = length <= counts
                met = cost[np.minimum(starts + length, len(keys))] - cost[starts]
                total = np.where(fits, length + met / m, np.inf)
                matches = np.where(total < best, m, matches)
                best = np.minimum(best, total)
            length = np.where(counts > 0, slack + matches, 0)
            kept = np.arange(len(keys)) - np.repeat(starts, counts) < np.repeat(length, counts)
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            signed = (keys[kept] ^ np.uint64(1 << 63)).view(np.int64)  # the same order for signed numbers
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed))
            arrays = [batch.column("doc_id"), pa.array(counts), pa.array(s1), pa.array(s2), pa.array(matches.astype(np.int32)), lists]
            out = pa.RecordBatch.from_arrays(arrays, ["doc_id", *SIGNATURE, "l", "elements"])
            yield out.filter(pa.array(counts > 0))

    return docs.mapInArrow(run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, l int, elements array<bigint>")


def least_overlap(n: Column, m: Column, percent: int) -> Column:
    """Elements that linked sets of these sizes share at least."""
    return F.ceil(percent * (n + m) / F.lit(100 + percent) - 1e-9)


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether an element at these places can be the first common one of linked sets of these sizes."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    sizes = (100 * x("n") >= percent * y("n")) & (100 * y("n") >= percent * x("n"))
    rest = F.least(x("n") - x("place"), y("n") - y("place")) + 1
    return sizes & (rest >= least_overlap(x("n"), y("n"), percent))


def both_sides(pairs: DataFrame, sides: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``pairs`` with the ``values`` of both classes (x_ and y_), found by the keys (a_ and b_ in ``pairs``)."""
    out = pairs
    for side, name in (("a", "x"), ("b", "y")):
        own = sides.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], *[F.col(v).alias(f"{name}_{v}") for v in values])
        match = F.lit(True)
        for k in keys:
            match &= F.col(f"{side}_{k}") == F.col(f"{name}_{k}")
        out = out.join(own, match).drop(*[f"{name}_{k}" for k in keys])
    return out


def promising(pairs: DataFrame, prefix: DataFrame, percent: int) -> DataFrame:
    """Pairs whose prefixes share as many elements as the smaller l asks for, and leave enough behind them."""
    keyed = pairs.select("a", "b", F.col("a").alias("a_class"), F.col("b").alias("b_class"))
    both = both_sides(keyed, prefix, ["class"], ["n", "l", "elements"])
    # Up to the end of the shorter prefix all common elements are in both; behind it there are no more than either set has.
    end = F.least(F.element_at("x_elements", -1), F.element_at("y_elements", -1))
    behind = [F.col(f"{s}_n") - F.size(F.filter(f"{s}_elements", lambda e: e <= F.col("end"))) for s in ("x", "y")]
    common = F.size(F.array_intersect("x_elements", "y_elements"))
    shared = both.withColumn("end", end).withColumn("common", common).where(F.col("common") >= F.least("x_l", "y_l"))
    return shared.where(F.col("common") + F.least(*behind) >= least_overlap(F.col("x_n"), F.col("y_n"), percent)).select("a", "b")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """key and sorted set of each document whose signature may be wanted.

    A bit map over the wanted signatures, of a fixed size, spares most other documents the shuffle that follows; the joins
    are exact.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_map(wanted.select("s1")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for batch in slices(batches):
            rows, hashes, counts = shingles(batch.column("text"), size)
            s1, s2 = signatures(rows, hashes, counts)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), pa.array(s1), pa.array(s2), lists], names)
            yield out.filter(pa.array(marks.has(s1) & (counts > 0)))

    names = ["doc_id", *SIGNATURE, "elements"]
    return docs.mapInArrow(run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, elements array<bigint>")


def known_id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name), F.lit(-(2**63)))


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets link."""
    keys = ["id", *SIGNATURE]
    named = classes.select("class", known_id().alias("id"), *SIGNATURE)
    for side in ("a", "b"):
        own = named.select(F.col("class").alias(side), *[F.col(k).alias(f"{side}_{k}") for k in keys])
        pairs = pairs.join(own, side)
    pairs = written(pairs, "pairs")
    wanted = pairs.select(F.col("a_s1").alias("s1")).union(pairs.select(F.col("b_s1").alias("s1")))
    sets = full_sets(docs, wanted, size).withColumn("id", known_id()).select(*keys, "elements").dropDuplicates(keys)

    both = both_sides(pairs, sets, keys, ["elements"])
    both = both.withColumn("common", F.size(F.array_intersect("x_elements", "y_elements")).cast("long"))
    linked = 100 * F.col("common") >= percent * (F.size("x_elements") + F.size("y_elements") - F.col("common"))
    return written(both.where(linked).select("a", "b"), "links")


def links(docs: DataFrame, classes: DataFrame, table, size: int, percent: int) -> DataFrame:
    """node and root of every class that links with another one."""
    packed = prefixes(docs, table, size, percent).withColumn("id", known_id())
    own = packed.join(classes.select("class", known_id().alias("id"), *SIGNATURE), [*SIGNATURE, "id"]).dropDuplicates([*SIGNATURE, "id"])
    own = written(own.select("class", "n", "l", "elements"), "prefixes")
    base = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    entries = own.select("class", "n", F.posexplode(F.slice("elements", F.lit(1), base.cast("int"))).alias("place", "element"))
    entries = entries.withColumn("place", F.col("place") + 1)
    shared = entries.groupBy("element").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1").select("element")
    entries = written(entries.join(shared, "element"), "entries")
    prefix = written(own.join(entries.select("class").distinct(), "class", "left_semi"), "prefixes")

    hub = entries.groupBy("element").agg(F.min(F.struct("place", "class", "n")).alias("hub"))
    met = entries.join(hub, "element").select("class", F.struct("n", "place").alias("x"), "hub")
    met = met.where((F.col("class") != F.col("hub.class")) & may_link("x", "hub", percent))
    pairs = met.select(F.least("class", "hub.class").alias("a"), F.greatest("class", "hub.class").alias("b")).distinct()
    found = verified(promising(pairs, prefix, percent), docs, classes, size, percent)
    stars = connected(found)

    # Second round: pairs across components, by element and component first.
    placed = entries.join(stars.withColumnRenamed("node", "class"), "class", "left")
    placed = written(placed.withColumn("component", F.coalesce("root", "class")).drop("root"), "placed")
    grouped = placed.groupBy("element", "component").agg(F.min("place").alias("place"), F.min("n").alias("low_n"), F.max("n").alias("high_n"))
    x, y = grouped.alias("x"), grouped.alias("y")
    rest = F.least(F.col("x.high_n") - F.col("x.place"), F.col("y.high_n") - F.col("y.place")) + 1
    sizes = (100 * F.col("x.high_n") >= percent * F.col("y.low_n")) & (100 * F.col("y.high_n") >= percent * F.col("x.low_n"))
    across = x.join(
        y,
        (F.col("x.element") == F.col("y.element"))
        & (F.col("x.component") < F.col("y.component"))
        & sizes
        & (rest >= least_overlap(F.col("x.low_n"), F.col("y.low_n"), percent)),
    ).select("x.element", F.col("x.component").alias("left_component"), F.col("y.component").alias("right_component"))
    p, q = placed.alias("p"), placed.alias("q")
    met = (
        across.alias("m")
        .join(p, (F.col("m.element") == F.col("p.element")) & (F.col("m.left_component") == F.col("p.component")))
        .join(
            q,
            (F.col("m.element") == F.col("q.element"))
            & (F.col("m.right_component") == F.col("q.component"))
            & may_link("p", "q", percent),
        )
    )
    pairs = met.select(F.least("p.class", "q.class").alias("a"), F.greatest("p.class", "q.class").alias("b")).distinct()
    more = verified(promising(pairs, prefix, percent), docs, classes, size, percent)
    return connected(stars.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """A row per document: doc_id, n_shingles, class_id (least id of the same set) and component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = written(profiles(docs, words), "profile")
    table = docs.sparkSession.sparkContext.broadcast(frequency_table(profile))
    rows = profile.where("n is not null").select("doc_id", *SIGNATURE)
    classes = rows.where("n > 0").groupBy(*SIGNATURE).agg(F.min("doc_id").alias("doc_id"))
    classes = written(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    roots = links(docs, classes, table, words, percent)
    placed = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(least, "root").select(*SIGNATURE, F.col("doc_id").alias("class_id"), "component_id")
    return rows.join(written(named, "named"), SIGNATURE, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one with the smallest id; a missing id comes last.

    Rows are told apart by id and text, so that repeated and missing ids count like others; of rows with the same id and text one stays.
    Rows with neither an id nor a word stay.
    """
    unnamed = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(PATTERN), F.lit(False))
    keyed = docs.where(~unnamed).withColumn("__key", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))
    found = components(keyed.select(F.col("__key").alias("doc_id"), "text"), words, percent)
    ids = keyed.select("__key", F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    placed = ids.join(found.select(F.col("doc_id").alias("__key"), "component_id").distinct(), "__key")
    least = placed.groupBy("component_id").agg(F.min(F.struct("none", "id", "__key")).alias("least"))
    kept = written(least.select("least.__key"), "kept")
    named = keyed.join(kept, "__key").dropDuplicates(["__key"]).select(*docs.columns)
    return named.unionByName(docs.where(unnamed))
