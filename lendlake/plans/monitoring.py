"""Area under the curve over time, from the written counts of scores; predictions are not read again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.functions.dates import as_date, trailing_window
from lendlake.operators.metrics import auc_of_counts
from lendlake.plans.modelling import run_counts
from lendlake.schemas import SNAPSHOT
from lendlake.sources.store import Store


KEYS = ("model_name", "run_date", "split", "start_date", "end_date")


def latest_run(store: Store, split: str, model_name: str) -> date | None:
    counts = store.read("gold", "score_counts").where((F.col("split") == split) & (F.col("model_name") == model_name))
    return counts.agg(F.max("run_date")).first()[0]


def in_range(counts: DataFrame, start: date | str, end: date | str) -> DataFrame:
    return counts.where(F.col(SNAPSHOT).between(F.lit(as_date(start)), F.lit(as_date(end))))


def auc_of_range(
    store: Store, start: date | str, end: date | str, sets: list[str], model_name: str = "logistic", run_date: date | str | None = None
) -> DataFrame:
    """One area for each set over all snapshots of the range together, from their counts added up."""
    run = as_date(run_date) if run_date else latest_run(store, sets[0], model_name)
    return auc_of_counts(in_range(run_counts(store, model_name, run, sets), start, end), ["split"])


def monitor(
    store: Store,
    start: date | str,
    end: date | str,
    split: str = "test",
    model_name: str = "logistic",
    run_date: date | str | None = None,
) -> DataFrame:
    """One row per snapshot in the range that the run has predictions for; written by model, run, set and range.

    Without ``run_date`` it is the latest run of the model. A range without predictions has no rows, also if there were some.
    """
    run = as_date(run_date) if run_date else latest_run(store, split, model_name)
    values = dict(zip(KEYS, (model_name, run, split, as_date(start), as_date(end)), strict=True))
    if run is not None:
        areas = auc_of_counts(in_range(run_counts(store, model_name, run, [split]), start, end), [SNAPSHOT], "test_auc")
        rows = areas.withColumns({name: F.lit(value) for name, value in values.items()})
        folder = "/".join(f"{name}={value}" for name, value in values.items())
        store.write(rows, "gold", "monitoring", partition_by=KEYS, own=[folder])
    return auc_over_time(store, start, end, split, model_name, run)


def monitor_trailing(store: Store, end: date | str, days: int = 30, split: str = "test") -> DataFrame:
    return monitor(store, *trailing_window(end, days), split)


def auc_over_time(
    store: Store,
    start: date | str,
    end: date | str,
    split: str = "test",
    model_name: str = "logistic",
    run_date: date | str | None = None,
) -> DataFrame:
    """The written series of one set and range, in date order; of the latest run without ``run_date``."""
    rows = store.read("gold", "monitoring")
    in_range = rows.where((F.col("start_date") == F.lit(as_date(start))) & (F.col("end_date") == F.lit(as_date(end))))
    own = in_range.where((F.col("split") == split) & (F.col("model_name") == model_name))
    run = as_date(run_date) if run_date else own.agg(F.max("run_date")).first()[0]
    return own.where(F.col("run_date") == F.lit(run).cast("date")).select("snapshot_date", "test_auc").orderBy("snapshot_date")
