"""What a long run leaves on disk on its way."""

import gzip
import time
from datetime import date
from pathlib import Path

import pytest
from lendlake import schemas as S
from lendlake.operators import bronze
from lendlake.plans import backfill, queries
from lendlake.sources import driver_tables, scratch, text
from lendlake.sources.store import Store
from pyspark.sql import functions as F


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {path.name for folder in folders for path in Path(folder).rglob("shuffle_*.data")}


def left_behind(spark, before):
    """Shuffle files that are still there; they are removed in the background."""
    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def ledger(spark):
    """400 rows of four months in three tasks; columns without rows of their own are NULL."""
    days = [(f"L{i}", f"CUS_{i % 40}", date(2023, 1 + i % 4, 1)) for i in range(400)]
    given = spark.createDataFrame(days, "loan_id string, Customer_ID string, snapshot_date date").repartition(3)
    return given.select(*[F.col(c) if c in given.columns else F.lit(None).cast("string").alias(c) for c in S.RAW_COLUMNS["loans"]])


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Customers, orders and their lines as the sources read them."""
    tables = {
        "customer": ["id as c_custkey", "concat('Ann ', id) as c_name", "cast(id % 25 as int) as c_nationkey", "id * 1.5D as c_acctbal", "'HOUSEHOLD' as c_mktsegment"],
        "orders": ["id as o_orderkey", "id % 100 as o_custkey", "id * 10.25D as o_totalprice", "timestamp(date_add(date'1995-01-01', cast(id as int))) as o_orderdate"],
        "lineitem": [
            "id div 2 as l_orderkey", "cast(id % 2 + 1 as int) as l_linenumber", "id % 50 * 1.0D as l_quantity", "id * 3.5D as l_extendedprice", "0.05D as l_discount",
            "0.02D as l_tax", "timestamp(date_add(date'1995-01-15', cast(id div 2 as int))) as l_shipdate",
        ],
    }
    for (name, columns), count in zip(tables.items(), (100, 300, 600), strict=True):
        spark.range(count).selectExpr(*columns).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """The files of finished steps would add up on the executors' disks. The session's own setting stays as it was."""
    before, kept = shuffle_files(spark), spark.conf.get(scratch.SHUFFLE_CLEANUP, None)
    store = Store(spark, f"{tmp_path}/store")
    store.write(ledger(spark), "bronze", "loans")
    text.write_source(ledger(spark), f"{tmp_path}/text")
    assert not left_behind(spark, before)
    assert store.counts["bronze", "loans"] == {"rows_out": 400} and store.read("bronze", "loans").count() == 400
    assert spark.conf.get(scratch.SHUFFLE_CLEANUP, None) == kept
    with pytest.raises(ZeroDivisionError), scratch.shuffles_dropped(spark):
        raise ZeroDivisionError
    assert spark.conf.get(scratch.SHUFFLE_CLEANUP, None) == kept


def test_run_counts_packs_its_text(spark, sf_dir, monkeypatch):
    """The text copies of the sources take less disk, and a file of them is small enough for one task."""
    given = {}
    monkeypatch.setattr(queries.backfill, "backfill", lambda spark, root, sources: given.update(sources) or Store(spark, root))
    monkeypatch.setattr(Store, "read", lambda self, *_: None)
    monkeypatch.setattr(text, "ROWS_PER_PACKED_FILE", 50, raising=False)
    queries.run_counts(spark, sf_dir)
    for name, raw in driver_tables.SOURCES.items():
        files, count = given[name].inputFiles(), raw(spark, sf_dir).count()
        assert count >= 100 and len(files) >= count / 50 and all(file.endswith(".csv.gz") for file in files)
        twice = 0 if name != "financials" else raw(spark, sf_dir).where(F.col("Customer_ID").endswith("5")).count()
        assert given[name].count() == count + twice


def test_rows_of_text_are_shuffled_as_one_text(spark):
    """Whatever stands in the cells comes out again; rows of other types are shuffled as they are."""
    cells = [None, "", "a", "\x01", "\x02", "x\x02y", "é\x01", "日本", 'a,b"\\', "\0", " "]
    days = [date(2023, 1, 1), date(2023, 2, 1)]
    given = [(a, b, days[(i + j) % 2], "other") for i, a in enumerate(cells) for j, b in enumerate(cells)]
    df = spark.createDataFrame(given, "`a.b` string, b string, snapshot_date date, cells string").withColumn("packed", F.col("b"))
    no_text = "cast(x'ff41' as string) as `a.b`", "cast(null as string) as b", "date'2023-01-01' as snapshot_date", "'c' as cells", "'p' as packed"
    df = df.unionByName(spark.range(1).selectExpr(*no_text))
    moved = bronze.spread_by_snapshot(df)
    assert moved.columns == df.columns
    hexed = [c if c == S.SNAPSHOT else F.hex(f"`{c}`") for c in df.columns]
    assert sorted(map(repr, moved.select(hexed).collect())) == sorted(map(repr, df.select(hexed).collect()))
    assert "array_join(" in moved._jdf.queryExecution().optimizedPlan().toString()
    typed = bronze.spread_by_snapshot(df.withColumn("b", F.lit(1)))._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in typed and "array_join(" not in typed


def test_headers_are_read_from_first_lines_only(spark, tmp_path):
    """No job sorts the text for its headers."""
    files = {"a.csv": b"id,Name\n1,Ann\n", "b.csv": "\n  \r\n\ufeffid,Name\r\n2,Bob\r\n".encode(), "c.csv": "\ufeffName,id\nCid,3".encode(), "d.csv": b"", "e.csv": b"\n\n"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(b"id,Name\r\n4,Dan\r\n"))
    spark.sparkContext.setJobGroup("headers", "headers")
    found = text.file_headers(spark, str(tmp_path))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    names = {header: [Path(file).name for file in paths] for header, paths in found.items()}
    assert names == {"id,Name": ["a.csv", "b.csv", "f.csv.gz"], "Name,id": ["c.csv"]}
    assert {(r.id, r.Name) for r in text.read_source(spark, str(tmp_path)).collect()} == {("1", "Ann"), ("2", "Bob"), ("3", "Cid"), ("4", "Dan")}


def test_tasks_that_sort_for_a_write_read_little(spark, monkeypatch):
    """Silver and risk rows are sorted by snapshot in the task that reads them; the session's own setting stays as it was."""
    kept, seen = spark.conf.get(scratch.READ_BYTES), {}
    monkeypatch.setattr(Store, "read", lambda self, layer, table, *_: ledger(spark).limit(0))
    monkeypatch.setattr(Store, "write", lambda self, df, layer, table, *_, **__: seen.update({(layer, table): spark.conf.get(scratch.READ_BYTES)}))
    monkeypatch.setattr(backfill.silver, "BUILDERS", {"loans": lambda df: df, "financials": lambda df: df})
    backfill.build_silver(Store(spark, "unused"))
    assert seen == {("silver", "loans"): "16m", ("silver", "financials"): "16m"} and spark.conf.get(scratch.READ_BYTES) == kept
