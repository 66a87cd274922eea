"""Reproducible shuffle into shards: a Feistel permutation of global row numbers, with cycle walking.

Rows are numbered 0 to N-1 in the order of their id, size and checksum. A number, written as a pair of remainders on a grid of
about the square root of N each way, is permuted by keyed Feistel rounds; where a result lies beyond N, the rounds are
applied again until it does not. The permuted number gives shard and slot by one division, so that anybody can compute a row's
place, and shards differ by at most one row. Native functions only.

Equal rows are counted before they are numbered, so that no window gathers them. They are interchangeable: which of them gets
which place has no meaning. A null id comes first; a null text has size 16 (no bytes) and checksum 0. An empty
table gives an empty table. Other columns are not used, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlake.llm.prefix import running_total
from lendlake.sources.scratch import written

ROUNDS = 6
BUCKETS = 1024
MOST_STEPS = 64


def grid(rows: int) -> tuple[int, int]:
    """Height and width of the smallest near-square grid with a cell for every row."""
    height = max(1, math.isqrt(max(0, rows - 1)) + 1)
    return height, max(1, -(-rows // height))


def feistel(number: Column, rows: int, seed: int, rounds: int = ROUNDS) -> Column:
    """One pass of the rounds; a permutation of the grid's cells."""
    height, width = grid(rows)
    low, high = F.pmod(number, F.lit(height)), F.floor(number / F.lit(height)).cast("long")
    for i in range(rounds):
        if i % 2 == 0:
            low = F.pmod(low + F.pmod(F.xxhash64(F.lit(seed), F.lit(i), high), F.lit(height)), F.lit(height))
        else:
            high = F.pmod(high + F.pmod(F.xxhash64(F.lit(seed), F.lit(i), low), F.lit(width)), F.lit(width))
    return low + high * F.lit(height)


def permuted(number: Column, rows: int, seed: int) -> Column:
    """The place of ``number`` in a keyed permutation of 0 to ``rows`` - 1.

    A walk meets each cell beyond ``rows`` once at most. There are fewer of them than the grid is high, so with up to
    MOST_STEPS of them the walk is complete by proof; with more, the chance of a longer walk is below 2**-300 a row, and
    it raises an error instead of giving a wrong place.
    """
    height, width = grid(rows)
    beyond = height * width - rows
    first = feistel(number, rows, seed)
    if not beyond:
        return first
    steps = F.sequence(F.lit(1), F.lit(min(beyond, MOST_STEPS)))
    place = F.aggregate(steps, first, lambda at, _: F.when(at < rows, at).otherwise(feistel(at, rows, seed)))
    return F.when(place < rows, place).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """Global row numbers ``row_number`` by doc_id, text_crc32 and size, and how many rows there are."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keys = ["doc_id", "size", "text_crc32"]
    sized = docs.select(F.col("doc_id").cast("long"), (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    counted = written(sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")), "sized")
    marks = [i / BUCKETS for i in range(1, BUCKETS)]
    rows, bounds = counted.agg(F.sum("copies"), F.percentile_approx("doc_id", marks, 10 * BUCKETS)).first()
    # Any bounds give the same numbers; they only spread the rows.
    order = [F.asc_nulls_first("doc_id"), F.col("text_crc32"), F.col("size")]
    placed = apart(bucketed(counted, "doc_id", sorted(set(bounds or []))), sorted(set(bounds or [])))
    total = running_total(placed, [], "bucket", order, "copies", "first_number")
    each = total.select(*keys, F.explode(F.sequence("first_number", F.col("first_number") + F.col("copies") - 1)).alias("row_number"))
    return each, rows or 0


def bucketed(df: DataFrame, column: str, bounds: list[int]) -> DataFrame:
    """Adds ``bucket``: how many of the bounds lie at or below the value, found by halving; 0 for a null."""
    held, powers = F.lit(bounds).cast("array<bigint>"), [1 << i for i in reversed(range(len(bounds).bit_length()))]
    below = lambda at, power: F.when(F.get(held, at + power - 1) <= F.col(column), power).otherwise(0)
    found = F.aggregate(F.lit(powers).cast("array<int>"), F.lit(0), lambda at, power: at + below(at, power))
    return df.withColumn("bucket", found)


def apart(df: DataFrame, bounds: list[int]) -> DataFrame:
    """Cuts the rows of a bucket's first id by checksum; only an id that fills a bucket, or a missing one, has many rows."""
    lowest = F.get(F.lit(bounds).cast("array<bigint>"), F.col("bucket") - 1)
    cut = F.shiftright("text_crc32", 32 - (BUCKETS.bit_length() - 1)).cast("int")
    part = F.when(F.col("doc_id").isNull() | (F.col("bucket") > 0) & (F.col("doc_id") == lowest), cut).otherwise(BUCKETS)
    return df.withColumn("bucket", F.col("bucket").cast("long") * (BUCKETS + 1) + part)


def shard(docs: DataFrame, shards: int = 40, seed: int = 1) -> DataFrame:
    """doc_id, size, text_crc32, the global row_number, and its shard and slot."""
    each, rows = numbered(docs)
    place = each.withColumn("place", permuted(F.col("row_number"), rows, seed))
    return place.select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
    )
