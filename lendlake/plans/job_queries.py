"""Registered queries over the jobs that write: backfills, rebuilds, sets, model runs and monitoring."""

from __future__ import annotations

from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake import schemas as S
from lendlake.functions.dates import month_list
from lendlake.operators import bronze, metrics, silver
from lendlake.plans import backfill, modelling, monitoring
from lendlake.plans.queries import assigned, model_table, scored
from lendlake.sources import driver_tables as D
from lendlake.sources.scratch import scratch_root, written
from lendlake.sources.store import Store

REBUILT_SINCE = date(1996, 1, 1)
RUNS = {"logistic": "2024-12-01", "other": "2025-01-01"}
MONITORED = {"logistic": "test", "other": "val"}
TOLERANCE = 1e-3
MONITORED_RANGES = [("1995-03-01", "1995-09-30"), ("1995-06-01", "1998-12-31")]


def backfill_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model table from all four sources, the later half of the months built first."""
    sources = {name: source(spark, sf_dir) for name, source in D.SOURCES.items()}
    bounds = bronze.counts_by_snapshot(sources).agg(F.min(S.SNAPSHOT), F.max(S.SNAPSHOT)).first()
    months = month_list(*bounds)
    root, half = scratch_root(spark), len(months) // 2
    backfill.backfill(spark, root, sources, months[half:])
    return backfill.backfill(spark, root, sources, months[:half]).read("gold", "model_table")


def store_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label counts after a rebuild with later months only and another month on book; the earlier build leaves nothing behind."""
    store = Store(spark, scratch_root(spark))
    ledger = written(D.raw_loans(spark, sf_dir), "ledger", by=S.SNAPSHOT)
    for rows, mob in ((ledger, 5), (ledger.where(F.col(S.SNAPSHOT) >= F.lit(REBUILT_SINCE)), 6)):
        backfill.build_bronze(store, {"loans": rows}, aligned=True)
        store.write(silver.silver_loans(store.read("bronze", "loans")), "silver", "loans", aligned=True)
        backfill.build_labels(store, mob=mob)
    return metrics.label_profile(store.read("gold", "label_store"))


def splits_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets after two builds with other gates and a first month that arrives last."""
    store = Store(spark, scratch_root(spark))
    table = written(model_table(spark, sf_dir), "model_table")
    first = table.agg(F.min(S.SNAPSHOT)).first()[0]
    store.write(table.where(F.col(S.SNAPSHOT) > F.lit(first)), "gold", "model_table")
    for n_train in (12, 6):
        backfill.build_splits(store, n_train=n_train)
    store.write(bronze.snapshot_slice(table, first), "gold", "model_table", [first])
    backfill.build_splits(store, [first], n_train=6)
    return store.read("gold", "splits")


def prediction_checks() -> list:
    """Rows, bads, and whether probabilities and hard predictions are what they should be."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.sum("label").alias("bad_count"),
        F.bool_and(F.col("probability").between(0, 1)).alias("in_range"),
        F.bool_and((F.col("prediction") == 1) == (F.col("probability") > 0.5)).alias("by_half"),
    ]


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs and their monitoring leave in the store, by run and set."""
    store = Store(spark, scratch_root(spark))
    store.write(assigned(spark, sf_dir), "gold", "splits", partition_by=(S.SNAPSHOT, "split"))
    model_dir = modelling.train(store, RUNS["logistic"])
    modelling.score_sets(store, model_dir, RUNS["other"], "other")
    for name, split in MONITORED.items():
        monitoring.monitor(store, "1990-01-01", "2000-12-01", split, name)
    keys = ["model_name", "run_date", "split"]
    checked = store.read("gold", "predictions").groupBy(*keys).agg(*prediction_checks())
    areas = store.read("gold", "model_manifest").groupBy(*keys).agg(F.count("auc").alias("areas"))
    series = store.read("gold", "monitoring").groupBy(*keys).agg(F.count(F.lit(1)).alias("monitored_months"))
    return checked.join(areas, keys, "full").join(series, keys, "full").fillna(0, ["monitored_months"])


def model_score_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a saved and loaded model by set.

    A logistic regression without a penalty solves the score equations: over the training rows, residuals sum to 0, alone and times
    each standardised feature. ``balanced`` says that all these means are below a tolerance; other sets have none.
    """
    rows = written(assigned(spark, sf_dir), "splits").where(F.col("split").isin("train", *modelling.HOLDOUT))
    model_dir = f"{scratch_root(spark)}/model"
    modelling.fit_model(rows.where(F.col("split") == "train"), max_iter=500).save(model_dir)
    model = PipelineModel.load(model_dir)
    scored = model.transform(rows).select(
        "split", "label", "prediction", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("probability")
    )
    residual = F.col("probability") - F.col("label")
    width = model.stages[-1].numFeatures
    means = [F.abs(F.avg(residual)), *[F.abs(F.avg(residual * F.col("x")[i])) for i in range(width)]]
    balanced = F.when(F.col("split") == "train", F.greatest(*means) < TOLERANCE)
    return scored.groupBy("split").agg(*prediction_checks(), balanced.alias("balanced"))


def fixed_run(spark: SparkSession, sf_dir: str) -> Store:
    """A store with the predictions of a fixed score, so that areas can be checked in SQL."""
    store = Store(spark, scratch_root(spark))
    rows = scored(spark, sf_dir).withColumns({"probability": F.col("score"), "prediction": F.lit(0.0)})
    columns = ["loan_id", "snapshot_date", "label", "probability", "prediction", "split"]
    modelling.record(store, rows.select(*columns), "fixed", RUNS["logistic"], "fixed")
    return store


def monitoring_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written series of one run, set and range."""
    return monitoring.monitor(fixed_run(spark, sf_dir), *MONITORED_RANGES[0], "test", "fixed")


def monitoring_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of each set over two overlapping ranges, from stored counts of single snapshots, beside the areas in the manifest."""
    store = fixed_run(spark, sf_dir)
    parts = [store.read("gold", "model_manifest").select("split", "auc", F.lit("manifest").alias("over"))]
    for start, end in MONITORED_RANGES:
        areas = monitoring.auc_of_range(store, start, end, modelling.HOLDOUT, "fixed")
        parts.append(areas.withColumn("over", F.lit(f"{start} to {end}")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES = {
    "monitoring_series": monitoring_series,
    "monitoring_ranges": monitoring_ranges,
    "backfill_months": backfill_months,
    "store_rebuild": store_rebuild,
    "splits_rebuild": splits_rebuild,
    "model_runs": model_runs,
    "model_score_equations": model_score_equations,
}
