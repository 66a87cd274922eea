"""Layered Parquet store: one dataset per table, partitioned, re-runs overwrite in place."""

from __future__ import annotations

import logging
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lendlake.operators.bronze import counts_by_snapshot, snapshot_slices
from lendlake.schemas import SNAPSHOT, TABLES
from lendlake.sources.scratch import shuffles_dropped

log = logging.getLogger(__name__)


def _observed(observation: Observation) -> dict[str, int]:
    """What a write has counted; nothing where Spark has found out that no row comes and has left the step out."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


class Store:
    """Tables ``<root>/<layer>/<table>`` with fixed schemas (``schemas.TABLES``).

    ``root`` has to be on a file system that every executor reaches. ``other_columns``
    are further text columns of the raw sources, kept by the bronze and silver tables.
    """

    def __init__(self, spark: SparkSession, root: str, other_columns: dict[str, list[str]] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.other_columns = other_columns or {}
        self.counts: dict[tuple[str, str], dict[str, int]] = {}

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str, months: list[date] | None = None) -> DataFrame:
        """The table, or the partitions of ``months``; a month without data has no rows."""
        others = self.other_columns.get(table, []) if layer in ("bronze", "silver") else []
        schema = ", ".join([TABLES[layer, table], *[f"`{name}` string" for name in others]])
        df = self.spark.read.schema(schema).parquet(self.path(layer, table))
        return df if months is None else snapshot_slices(df, months)

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        months: list[date] | None = None,
        partition_by: tuple[str, ...] = (SNAPSHOT,),
        aligned: bool = False,
        own: list[str] | None = None,
        observed: list[Observation] | None = None,
    ) -> None:
        """Replace what the write owns: the partitions of ``months``, or the whole table without months.

        ``own`` names other partition folders instead, such as those of one model run. Rows are rebalanced by partition value,
        so that a month ends up in few files and a month with a large share of all rows is spread over many tasks. ``aligned`` says
        that ``df`` derives row by row from a table with the same snapshot partitions: its tasks hold few months each, and the
        write needs no shuffle. ``df`` runs once, and its shuffle files go with it. Partition folders that were there before and that the write has not replaced are removed
        as wholes after it has succeeded.

        The rows written, and what ``observed`` counts further up in ``df``, are taken along by the write itself and kept in ``counts``.
        """
        whole = [""] if months is None else [f"{SNAPSHOT}={month.isoformat()}" for month in months]
        owned = whole if own is None else own
        before = self._folders(layer, table, owned)
        rows = Observation()
        df = df.observe(rows, F.count(F.lit(1)).alias("rows_out"))
        spread = df if aligned else df.hint("rebalance", *[F.col(c) for c in partition_by])
        with shuffles_dropped(self.spark):
            (
                spread.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", "zstd")
                .partitionBy(*partition_by)
                .parquet(self.path(layer, table))
            )
        after = self._folders(layer, table, owned) if before else {}
        for name, files_before in before.items():
            if files_before == after.get(name):
                folder, files = self._folder(name)
                files.delete(folder, True)
        self.counts[layer, table] = {"rows_out": 0} | {k: v for o in [rows, *(observed or [])] for k, v in _observed(o).items()}
        log.info("wrote %s", self.path(layer, table))

    def write_counts(self) -> None:
        """What the writes of this store have counted, a row for each table; other tables keep the counts of their last run."""
        names = ["rows_in", "undated", "repeated_rows", "rows_out"]
        rows = [(layer, table, *[c.get(n) for n in names]) for (layer, table), c in self.counts.items()]
        counted = self.spark.createDataFrame(rows, TABLES["meta", "run_counts"]).coalesce(1)
        own = [f"layer={layer}/table_name={table}" for layer, table in self.counts]
        self.write(counted, "meta", "run_counts", partition_by=("layer", "table_name"), aligned=True, own=own)
        self.counts.clear()

    def row_counts(self, *tables: tuple[str, str]) -> DataFrame:
        """Rows of each written table and snapshot, counted without reading any column."""
        return counts_by_snapshot({f"{layer}.{table}": self.read(layer, table) for layer, table in tables})

    def months(self, layer: str, table: str) -> list[date]:
        """Snapshots of a written table that has them as its first partition, from its folder names."""
        folder, files = self._folder(self.path(layer, table))
        names = [entry.getPath().getName() for entry in files.listStatus(folder)] if files.exists(folder) else []
        values = [name.partition("=")[2] for name in names if name.startswith(f"{SNAPSHOT}=")]
        return sorted(date.fromisoformat(value) for value in values if value[:1].isdigit())

    def _folders(self, layer: str, table: str, folders: list[str]) -> dict[str, set[str]]:
        """Data files of each partition folder below the named ones, from one listing of each of these."""
        found: dict[str, set[str]] = {}
        for name in folders:
            folder, files = self._folder(f"{self.path(layer, table)}/{name}".rstrip("/"))
            if files.exists(folder):
                entries = files.listFiles(folder, True)
                while entries.hasNext():
                    path = entries.next().getPath()
                    if not path.getName().startswith(("_", ".")):
                        found.setdefault(path.getParent().toString(), set()).add(path.getName())
        return found

    def _folder(self, path: str):
        """Hadoop path and its file system."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
