"""Slices of the raw sources by snapshot date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.schemas import SNAPSHOT

BETWEEN, MISSING = "\x01", "\x02"


def snapshot_slice(df: DataFrame, snapshot: date | str) -> DataFrame:
    return df.where(F.col(SNAPSHOT) == F.lit(snapshot).cast("date"))


def snapshot_slices(df: DataFrame, months: list[date] | None = None) -> DataFrame:
    """Every dated row, or only the rows of ``months``; ``rejected_counts`` counts the others."""
    if months is None:
        return df.where(F.col(SNAPSHOT).isNotNull())
    return df.where(F.col(SNAPSHOT).isin(months))


def spread_by_snapshot(df: DataFrame) -> DataFrame:
    """Rows rebalanced by snapshot. Rows of text go through the shuffle as one text each, which halves it, and come out in the order of their snapshots.

    A row with one of the two marks in a cell, or with a cell that is no valid text, goes through as its cells.
    """
    names = [name for name in df.columns if name != SNAPSHOT]
    if any(dict(df.dtypes)[name] != "string" for name in names):
        return df.hint("rebalance", F.col(SNAPSHOT))
    cells, whole = F.array(*[F.col(f"`{name}`") for name in names]), F.concat_ws("", *[F.col(f"`{name}`") for name in names])
    packs = F.is_valid_utf8(whole) & ~F.contains(whole, F.lit(BETWEEN)) & ~F.contains(whole, F.lit(MISSING))
    packed = df.select(F.col(SNAPSHOT), F.when(packs, F.array_join(cells, BETWEEN, MISSING)).alias("packed"), F.when(~packs, cells).alias("cells"))
    moved = packed.hint("rebalance", F.col(SNAPSHOT)).sortWithinPartitions(SNAPSHOT).withColumn("packed", F.split("packed", BETWEEN, -1))
    unpacked = [F.coalesce(F.nullif(F.get("packed", F.lit(i)), F.lit(MISSING)), F.get("cells", F.lit(i))).alias(name) for i, name in enumerate(names)]
    return moved.select(*unpacked, SNAPSHOT).select(*[F.col(f"`{name}`") for name in df.columns])


def counts_by_snapshot(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table and snapshot, in one job."""
    counts = None
    for name, df in tables.items():
        part = df.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("row_count"))
        part = part.select(F.lit(name).alias("source_table"), SNAPSHOT, "row_count")
        counts = part if counts is None else counts.unionByName(part)
    return counts


def rejected_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table without a valid snapshot date; these belong to no slice."""
    undated = {name: df.where(F.col(SNAPSHOT).isNull()) for name, df in tables.items()}
    return counts_by_snapshot(undated).drop(SNAPSHOT)


def available_snapshots(df: DataFrame) -> DataFrame:
    return df.select(SNAPSHOT).distinct()
