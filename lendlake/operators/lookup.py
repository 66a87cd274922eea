"""Left joins against feature tables that stay whole and even when keys are hot.

A feature table has at most one row per key, so a join cannot multiply the left rows.
Many left rows may share one key, though. Keys above ``rows_per_slice`` left rows are
cut into slices of about that size, and only their single feature row is repeated, once
per slice. There are at most ``left rows / rows_per_slice`` such keys, which bounds the
table of hot keys that is broadcast: a trillion left rows give at most a million.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendlake.schemas import SNAPSHOT

ROWS_PER_SLICE = 1_000_000
SLICE = "_slice"


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a repeated key are reduced to one of them, the same one on every run.

    The row with the smallest hash stays. Copies of a hot key go before the shuffle, as
    Spark limits the rows of each window on both of its sides, and a following join on
    ``keys`` reuses the shuffle and the sort.
    """
    by_hash = W.partitionBy(*keys).orderBy("_hash")
    hashed = df.withColumn("_hash", F.xxhash64(*[c for c in df.columns if c not in keys]))
    return hashed.withColumn("_place", F.row_number().over(by_hash)).where("_place = 1").select(*df.columns)


def repeated_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows of each snapshot ``one_row_per_key`` leaves out; only the key columns are read, and copies are added up before the shuffle."""
    left_out = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("_more")).where("_more > 0")
    return left_out.groupBy(SNAPSHOT).agg(F.sum("_more").alias("repeated_rows"))


def hot_keys(df: DataFrame, keys: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Keys that hold more than ``rows_per_slice`` rows, with the slices they need."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows_per_slice)
    return counted.select(*keys, F.ceil(F.col("_rows") / rows_per_slice).cast("int").alias("_slices"))


def _with_slices(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    right = F.broadcast(hot).alias("hot")
    same_key = F.expr(" and ".join(f"left.{key} <=> hot.{key}" for key in keys))
    return df.alias("left").join(right, same_key, "left").selectExpr("left.*", "coalesce(_slices, 1) as _slices")


def lookup_join(
    left: DataFrame,
    unique: list[DataFrame],
    repeating: list[DataFrame],
    keys: list[str],
    spread_by: list[Column],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``left`` with the columns of every feature table; NULL where a key is absent.

    ``unique`` tables have one row per key already; ``repeating`` ones may not and are
    reduced with ``one_row_per_key``. The left rows are shuffled once, on the key and
    the slice, whatever the number of tables. ``spread_by`` are left columns that tell
    rows of one key apart.
    """
    hot = hot_keys(left, keys, rows_per_slice)
    on = [*keys, SLICE]
    place = F.pmod(F.xxhash64(*spread_by), F.col("_slices")).cast("int")
    joined = _with_slices(left, hot, keys).select(*left.columns, place.alias(SLICE))
    copies = F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias(SLICE)
    tables = [_with_slices(table, hot, keys).select(*table.columns, copies) for table in unique]
    for table in repeating:
        sliced = _with_slices(table, hot, keys).select(*table.columns, copies)
        tables.append(one_row_per_key(sliced, on))
    for table in tables:
        joined = joined.join(table, on, "left")
    return joined.drop(SLICE)
