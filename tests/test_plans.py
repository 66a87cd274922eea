"""Shape of the physical plans: what must be there at scale, and what must not."""

import re
from pathlib import Path

import pytest
from lendlake.operators import gold, lookup, silver
from lendlake.plans import backfill
from lendlake.plans import queries as Q
from lendlake.sources import driver_tables
from lendlake.sources.store import Store
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NOT_LAZY = {"attributes_store", "bronze_rejected_lines", "csv_ingest", "csv_three_headers", "run_counts", "train_and_score", "training_manifest", "store_roundtrip"}


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - NOT_LAZY))
def test_no_python_and_no_cross_products(spark, name):
    plan = physical(Q.QUERIES[name](spark, SF_DIR))
    assert not re.search("Python|Pandas|Cartesian|BroadcastNestedLoop", plan)


def test_only_needed_columns_are_read(spark):
    plan = physical(Q.labels(spark, SF_DIR))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("l_shipdate" in scan and "l_tax" not in scan and "l_partkey" not in scan for scan in scans)
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_slice_filter_reaches_the_scan_of_written_labels(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write(Q.loans(spark, SF_DIR), "silver", "loans")
    plan = physical(gold.default_labels(store.read("silver", "loans")))
    assert "EqualTo(mob,6)" in plan


@pytest.fixture
def shuffled_joins(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "-1")
    yield
    spark.conf.unset(setting)


def test_one_shuffle_per_table_of_the_model_table(spark, shuffled_joins, tmp_path):
    """Labels, engagement and risk are each shuffled once, plus the count of hot keys."""
    store = Store(spark, str(tmp_path))
    store.write(Q.labels(spark, SF_DIR), "gold", "label_store")
    store.write(Q.engagement(spark, SF_DIR), "gold", "engagement")
    store.write(Q.risk(spark, SF_DIR), "gold", "risk")
    joined = gold.model_table(*[store.read("gold", t) for t in ("label_store", "engagement", "risk")])
    joined.collect()
    plan = physical(joined).split("Initial Plan")[0]
    by_slice = re.findall(r"Exchange hashpartitioning\(Customer_ID#\d+, snapshot_date#\d+, _slice#\d+", plan)
    assert len(by_slice) == 3
    assert len(re.findall("SortMergeJoin", plan)) == 2
    assert len(re.findall("WindowGroupLimit .* Partial", plan)) == 1
    assert len(re.findall(r"Sort \[", plan)) == 4


def test_engagement_sends_each_month_once(spark):
    plan = physical(gold.engagement(Q.silver_table(spark, SF_DIR, "clickstream")))
    assert plan.index("Generate explode") < plan.index("Window")
    assert "Expand" not in plan


@pytest.mark.parametrize("name", list(silver.BUILDERS))
def test_silver_needs_no_shuffle(spark, name, tmp_path):
    store = Store(spark, str(tmp_path))
    backfill.build_bronze(store, {name: driver_tables.SOURCES[name](spark, SF_DIR)})
    plan = physical(silver.BUILDERS[name](store.read("bronze", name)))
    assert "Exchange" not in plan
    assert "WholeStageCodegen" in plan or "*(1)" in plan
    store.write(silver.BUILDERS[name](store.read("bronze", name)), "silver", name, aligned=True)
    files = [len(list(Path(tmp_path).glob(f"{layer}/{name}/*/*.parquet"))) for layer in ("bronze", "silver")]
    assert files[1] <= files[0]


SKEW = "spark.sql.adaptive.skewJoin"


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        f"{SKEW}.skewedPartitionThresholdInBytes": "8k",
        f"{SKEW}.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_an_order_with_a_third_of_all_lines_is_split(spark, small_skew_limits, tmp_path):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    hot = lines.withColumn("l_orderkey", F.expr("if(l_partkey % 3 = 0, 3, l_orderkey)"))
    hot.repartition(6).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{SF_DIR}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    labels = Q.labels(spark, str(tmp_path))
    count = len(labels.collect())
    assert "SortMergeJoin(skew=true)" in physical(labels).split("Initial Plan")[0]
    assert count == hot.where("l_linenumber = 6").count()


def test_hot_labels_spread_over_the_shuffle(spark, shuffled_joins, tmp_path):
    """Half of the labels at one key reach the joins in many partitions, none of them large."""
    labels = Q.label_store(spark, SF_DIR)
    hot = labels.withColumns({"Customer_ID": F.expr("if(label = 1, 'CUS_1', Customer_ID)"), "snapshot_date": F.lit("1998-06-01").cast("date")})
    keys = ["Customer_ID", "snapshot_date"]
    placed = lookup._with_slices(hot, lookup.hot_keys(hot, keys, 4), keys)
    place = F.pmod(F.xxhash64("loan_id"), F.col("_slices")).cast("int").alias("_slice")
    spread = placed.select(*hot.columns, place).repartition(8, *keys, "_slice").groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in spread.collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
