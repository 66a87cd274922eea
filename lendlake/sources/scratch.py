"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
READ_BYTES = "spark.sql.files.maxPartitionBytes"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="lendlake-")


def scratch_root(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir``; a local session may do without it."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = _local_folder()
    return f"{folder.rstrip('/')}/lendlake-{uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session with another setting for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries that run within leave no shuffle files behind.

    Without it, the files of finished steps stay on the executors' disks until the driver's JVM happens to collect garbage.
    """
    return setting(spark, SHUFFLE_CLEANUP, "true")


def sorted_in_memory(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries that run within read 16 MB a task: a task that sorts its rows for a write holds them in memory and spills nothing."""
    return setting(spark, READ_BYTES, "16m")


def written(df: DataFrame, name: str = "table", by: str | None = None) -> DataFrame:
    """``df`` written once and read back: later uses read columns, not the whole plan.

    ``by`` names a last column to rebalance and partition by, so that a store's table with the same partitions is written from it without a shuffle.
    """
    path = f"{scratch_root(df.sparkSession)}/{name}"
    if by is None:
        df.write.parquet(path)
    else:
        df.hint("rebalance", F.col(by)).write.partitionBy(by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
