"""Layer builds over all months in one job each, or over chosen months only.

Every build reads a written table and replaces the partitions it owns, so a month can be run
again at any time and in any order and gives the same tables: a run also rebuilds the later snapshots that its click months feed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lendlake import schemas as S
from lendlake.functions.dates import shift_months
from lendlake.operators import gold, silver
from lendlake.operators.bronze import snapshot_slices, spread_by_snapshot
from lendlake.operators.lookup import repeated_rows
from lendlake.operators.splits import assign_splits, month_ranks
from lendlake.sources.scratch import shuffles_dropped, sorted_in_memory
from lendlake.sources.store import Store

Months = list[date] | None


def other_columns(sources: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Columns of each source that no rule names; they pass through as text."""
    return {name: [c for c in df.columns if c not in S.RAW_COLUMNS[name]] for name, df in sources.items()}


def build_bronze(store: Store, sources: dict[str, DataFrame], months: Months = None, aligned: bool = False) -> None:
    """Raw rows by snapshot; each source is read once for all months, and its rows and undated rows are counted on the way.

    Rows are rebalanced as they come and become text after it: most numbers are shorter than their text. ``aligned`` says that the sources
    are tables with the same snapshot partitions, whose rows need no shuffle.
    """
    for name, df in sources.items():
        columns = [*S.RAW_COLUMNS[name], *store.other_columns.get(name, [])]
        dated = df.select(*columns).withColumn(S.SNAPSHOT, F.col(S.SNAPSHOT).cast("date"))
        day, seen = F.col(S.SNAPSHOT), Observation()
        of_run = dated if months is None else dated.where(day.isin(months) | day.isNull())
        numbers = [F.count(F.lit(1)).alias("rows_in"), F.count_if(day.isNull()).alias("undated")]
        slices = snapshot_slices(of_run.observe(seen, *numbers), months)
        spread = slices if aligned else spread_by_snapshot(slices)
        as_text = spread.select(*[F.col(c).cast("date" if c == S.SNAPSHOT else "string").alias(c) for c in columns])
        store.write(as_text, "bronze", name, months, aligned=True, observed=[seen])
        if "rows_in" not in store.counts["bronze", name]:  # no row was written
            store.counts["bronze", name].update(of_run.agg(*numbers).first().asDict())


def build_rejects(store: Store, rejects: dict[str, DataFrame]) -> None:
    """Lines of each source that are no rows, as ``text.rejected_lines`` gives them; a source's lines are replaced as a whole."""
    for name, lines in rejects.items():
        named = lines.select(F.lit(name).alias("source_table"), "file", "reason", "line")
        own = [f"source_table={name}"]
        store.write(named, "bronze", "rejected_lines", partition_by=("source_table",), own=own)


def build_silver(store: Store, months: Months = None) -> None:
    """Cleaned rows, a job without any shuffle for each table."""
    with sorted_in_memory(store.spark):
        for name, build in silver.BUILDERS.items():
            store.write(build(store.read("bronze", name, months)), "silver", name, months, aligned=True)


def build_labels(store: Store, months: Months = None, dpd: int = 30, mob: int = 6) -> None:
    labels = gold.default_labels(store.read("silver", "loans", months), dpd, mob)
    store.write(labels, "gold", "label_store", months)


def shifted(store: Store, table: str, months: list[date], lags: list[int]) -> list[date]:
    """Snapshots of a silver table in the calendar months that lie ``lags`` after those of ``months``."""
    wanted = {shift_months(month.replace(day=1), lag) for month in months for lag in lags}
    return [snapshot for snapshot in store.months("silver", table) if snapshot.replace(day=1) in wanted]


def fed_snapshots(store: Store, months: Months) -> Months:
    """The ledger's snapshots whose engagement draws on ``months``: these and the six after them."""
    return None if months is None else shifted(store, "loans", months, [0, *S.LAGS])


def build_engagement(store: Store, months: Months = None, feature: str = "fe_1") -> None:
    """Lags for the snapshots of the loan ledger; a run reads the six months it needs."""
    needed = None if months is None else shifted(store, "clickstream", months, [-lag for lag in S.LAGS])
    clicks = store.read("silver", "clickstream", needed)
    ledger = [(month,) for month in store.months("silver", "loans") if months is None or month in months]
    snapshots = store.spark.createDataFrame(ledger, "snapshot_date date")
    store.write(gold.engagement(clicks, snapshots, feature), "gold", "engagement", months)


def build_risk(store: Store, months: Months = None) -> None:
    risk = gold.risk_features(store.read("silver", "financials", months))
    with sorted_in_memory(store.spark):
        store.write(risk, "gold", "risk", months, aligned=True)
    with shuffles_dropped(store.spark):
        repeated = repeated_rows(store.read("gold", "risk", months), S.KEY).agg(F.sum("repeated_rows")).first()[0]
    store.counts["gold", "risk"]["repeated_rows"] = repeated or 0


def build_gold(store: Store, months: Months = None, dpd: int = 30, mob: int = 6) -> None:
    """Gold tables of ``months``; engagement also of the later snapshots that these months feed."""
    build_engagement(store, None if months is None else sorted({*months, *fed_snapshots(store, months)}))
    build_risk(store, months)
    build_labels(store, months, dpd, mob)


def build_model_table(store: Store, months: Months = None) -> None:
    """Labels with their features; the only joins of the whole run."""
    joined = gold.model_table(
        store.read("gold", "label_store", months),
        store.read("gold", "engagement", months),
        store.read("gold", "risk", months),
    )
    store.write(joined, "gold", "model_table", months)


def build_splits(store: Store, months: Months = None, n_train: int = 12, n_oot: int = 3, key: str = "loan_id") -> None:
    """Sets of all months, or of ``months`` and those whose set they change.

    A new month shifts the rank of every later one, so these are written again; a month within the first ``n_train`` or
    before their end rewrites all. A month is replaced as a whole, whatever its sets were. After a change of ``n_train``,
    ``n_oot`` or ``key``, run it without months.
    """
    table = store.read("gold", "model_table")
    ranks = month_ranks(table)
    changed = None
    if months is not None:
        present = store.months("gold", "model_table")
        first = present[:n_train]
        since = present[0] if not first or min(months) <= first[-1] else min(months)
        changed = sorted({*months, *[month for month in present if month >= since]})
        table = snapshot_slices(table, changed)
    assigned = assign_splits(table, n_train, n_oot, key, ranks=ranks)
    store.write(assigned, "gold", "splits", changed, partition_by=(S.SNAPSHOT, "split"), aligned=True)


def backfill(
    spark: SparkSession,
    root: str,
    sources: dict[str, DataFrame],
    months: Months = None,
    dpd: int = 30,
    mob: int = 6,
) -> Store:
    """Sources to model table; the first failing step ends the run."""
    store = Store(spark, root, other_columns(sources))
    build_bronze(store, sources, months)
    build_silver(store, months)
    build_gold(store, months, dpd, mob)
    build_model_table(store, None if months is None else sorted({*months, *fed_snapshots(store, months)}))
    store.write_counts()
    return store
