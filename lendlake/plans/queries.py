"""Registered queries: every operator on the test tables, as ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake import schemas as S
from lendlake.functions.dates import months_between_bounds
from lendlake.operators import bronze, gold, metrics, silver, splits
from lendlake.plans import backfill, modelling
from lendlake.sources import driver_tables as D
from lendlake.sources import text
from lendlake.sources.scratch import scratch_root, written
from lendlake.sources.store import Store

SLICE_DATE = "1998-06-01"
CUT_OFF = "2000-01-01"
FINAL_INSTALMENT = 7
AUC_RANGE = ("1996-01-01", "1999-12-31")
TRAILING_DAYS = 365
DIRTY_COLUMNS = {"loans": "balance", "clickstream": "fe_3", "attributes": "Name", "financials": "Interest_Rate"}


def silver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return silver.BUILDERS[name](D.SOURCES[name](spark, sf_dir))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_table(spark, sf_dir, "loans")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.default_labels(loans(spark, sf_dir))


def bronze_snapshot_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.snapshot_slice(D.raw_loans(spark, sf_dir), SLICE_DATE)


def bronze_counts_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.counts_by_snapshot({name: source(spark, sf_dir) for name, source in D.SOURCES.items()})


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/financials_csv"
    columns = S.RAW_COLUMNS["financials"]
    text.write_source(D.raw_financials(spark, sf_dir).select(*columns), path)
    return bronze.snapshot_slices(text.read_source(spark, path))


def from_text(spark: SparkSession, sf_dir: str, name: str, packed: bool = False) -> DataFrame:
    """A source written as text with dirty cells and undated rows, and read again."""
    path = f"{scratch_root(spark)}/{name}_csv"
    text.write_source(D.as_dirty_text(D.SOURCES[name](spark, sf_dir), DIRTY_COLUMNS[name]), path, packed=packed)
    return text.read_source(spark, path)


def silver_from_text(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return silver.BUILDERS[name](bronze.snapshot_slices(from_text(spark, sf_dir, name)))

    return query


def bronze_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.rejected_counts({name: from_text(spark, sf_dir, name) for name in D.SOURCES})


def lines_of(raw: DataFrame) -> DataFrame:
    """Each row as a line of text; some lines get a cell too many, lose their last cell, or end in a cell whose quote is never closed."""
    cells = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])
    line = F.to_csv(F.struct(*cells.columns), {"emptyValue": "", "nullValue": ""})
    end = {"2": F.concat(line, F.lit(",surplus")), "4": F.regexp_replace(line, ",[^,]*$", ""), "6": F.concat(F.regexp_replace(line, ",([^,]*)$", ',"$1'))}
    out = line
    for digit, text_of in end.items():
        out = F.when(F.col("Customer_ID").endswith(digit), text_of).otherwise(out)
    return cells.select(out.alias("line"))


def bronze_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each source that are no rows, by reason, from the store; and the rows that were read."""
    store, root = Store(spark, scratch_root(spark)), scratch_root(spark)
    for name, source in D.SOURCES.items():
        raw = source(spark, sf_dir)
        text.write_lines(lines_of(raw), ",".join(raw.columns), f"{root}/{name}")
    backfill.build_rejects(store, {name: text.rejected_lines(spark, f"{root}/{name}") for name in D.SOURCES})
    lines = store.read("bronze", "rejected_lines").groupBy("source_table", "reason").agg(F.count(F.lit(1)).alias("row_count"))
    for name in D.SOURCES:
        read = text.read_source(spark, f"{root}/{name}").agg(F.count(F.lit(1)).alias("row_count"))
        lines = lines.unionByName(read.select(F.lit(name).alias("source_table"), F.lit("read").alias("reason"), "row_count"))
    return lines


def csv_three_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose files name the columns in another order, lack some, or have one more; rows are united by name."""
    path = f"{scratch_root(spark)}/financials_csv"
    raw = D.raw_financials(spark, sf_dir).select(*S.RAW_COLUMNS["financials"])
    part = F.regexp_extract("Customer_ID", "([0-9]+)$", 1).cast("int") % 3
    backwards = raw.where(part == 1).select(*reversed(raw.columns))
    fewer = raw.where(part == 2).drop("Credit_Mix", "Interest_Rate", "Monthly_Balance")
    more = raw.where(part == 0).withColumn("Branch", F.concat(F.lit("B, "), F.col("Num_of_Loan")))
    for df in (backwards, fewer, more):
        text.write_source(df, path, "append")
    return text.read_source(spark, path)


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a backfill counts on its way, from dirty text with undated rows and financial rows that stand there twice."""
    sources = {name: from_text(spark, sf_dir, name, packed=True) for name in D.SOURCES}
    times = F.when(F.col("Customer_ID").endswith("5"), 2).otherwise(1)
    twice = sources["financials"].select("*", F.explode(F.sequence(F.lit(1), times)).alias("copy"))
    sources["financials"] = twice.drop("copy")
    return backfill.backfill(spark, scratch_root(spark), sources).read("meta", "run_counts")


def attributes_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes through the bronze and silver writes; one month is built a second time."""
    store, name = Store(spark, scratch_root(spark)), "attributes"
    for months in (None, [date.fromisoformat(SLICE_DATE)]):
        backfill.build_bronze(store, {name: D.raw_attributes(spark, sf_dir)}, months)
        store.write(silver.silver_attributes(store.read("bronze", name, months)), "silver", name, months, aligned=True)
    return store.read("silver", name)


def month_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month between the first and the last snapshot, with its ledger rows."""
    counts = bronze.counts_by_snapshot({"loans": D.raw_loans(spark, sf_dir)})
    bounds = counts.agg(F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"))
    calendar = bounds.select(months_between_bounds(F.col("first"), F.col("last")).alias("snapshot_date"))
    joined = calendar.join(counts, "snapshot_date", "left")
    return joined.select("snapshot_date", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def silver_dpd_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans(spark, sf_dir).groupBy("mob", "installments_missed", "dpd").agg(F.count(F.lit(1)).alias("row_count"))


def financials(columns: list[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return silver_table(spark, sf_dir, "financials").select(*S.KEY, *columns)

    return query


def engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = bronze.available_snapshots(D.raw_loans(spark, sf_dir))
    return gold.engagement(silver_table(spark, sf_dir, "clickstream"), snapshots)


def risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.risk_features(silver_table(spark, sf_dir, "financials"))


def label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels written once: their source join is the largest one and they are used several times."""
    return written(labels(spark, sf_dir), "label_store")


def model_table(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Features of months without labels find no label row, so they need no calendar."""
    engaged = gold.engagement(silver_table(spark, sf_dir, "clickstream"))
    return gold.model_table(rows or label_store(spark, sf_dir), engaged, risk(spark, sf_dir))


def split_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.hash_split(labels(spark, sf_dir).select("loan_id", "snapshot_date"))


def assigned(spark: SparkSession, sf_dir: str, n_train: int = 12) -> DataFrame:
    rows = label_store(spark, sf_dir)
    return splits.assign_splits(model_table(spark, sf_dir, rows), n_train, ranks=splits.month_ranks(rows))


def split_policy_early_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.assign_splits(label_store(spark, sf_dir), n_train=6)
    return rows.groupBy("split", "snapshot_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("label").alias("bad_count")
    )


def linear_score(df: DataFrame) -> DataFrame:
    """A fixed score from four features, so that areas can be checked in SQL."""
    filled = {c: F.coalesce(c, F.lit(0)) for c in ("Interest_Rate", "Loan_Extent", "Outstanding_Debt", "click_1m")}
    return df.withColumn(
        "score",
        filled["Interest_Rate"] * F.lit(0.25)
        + filled["Loan_Extent"] * F.lit(0.125)
        + filled["Outstanding_Debt"] / 100000
        + filled["click_1m"] / 50000,
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear_score(assigned(spark, sf_dir))


def holdout_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.auc(scored(spark, sf_dir), "label", "score", ["split"])


def auc_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = D.table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = D.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return metrics.auc(quality.join(documents, "doc_id"), "quality", "n_chars", ["lang"])


def auc_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.auc_by_snapshot(scored(spark, sf_dir), *AUC_RANGE, score="score")


def auc_trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of the snapshots in the days up to the latest one."""
    rows = label_store(spark, sf_dir)
    last = rows.agg(F.max("snapshot_date")).scalar()
    in_window = linear_score(model_table(spark, sf_dir, rows)).where(F.col("snapshot_date") >= F.date_sub(last, TRAILING_DAYS))
    return metrics.auc(in_window, "label", "score", ["snapshot_date"], "test_auc")


def train_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the train set and score the holdout sets."""
    rows = written(assigned(spark, sf_dir), "splits")
    model = modelling.fit_model(rows.where(F.col("split") == "train"))
    return modelling.score(model, rows.where(F.col("split").isin(modelling.HOLDOUT)))


def training_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of the fitted model on its test and validation sets."""
    rows = modelling.manifest_rows(train_and_score(spark, sf_dir), "logistic", "logistic", "2024-12-01", "predictions")
    return modelling.training_manifest(rows)


def store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger to label store through written layers; one month is built a second time."""
    store = Store(spark, scratch_root(spark))
    raw = {"loans": D.raw_loans(spark, sf_dir)}
    backfill.build_bronze(store, raw)
    for months in (None, [date.fromisoformat(SLICE_DATE)]):
        store.write(silver.silver_loans(store.read("bronze", "loans", months)), "silver", "loans", months, aligned=True)
        backfill.build_labels(store, months)
    return metrics.label_profile(store.read("gold", "label_store"))


QUERIES = {
    "bronze_snapshot_slice": bronze_snapshot_slice,
    "bronze_counts_by_snapshot": bronze_counts_by_snapshot,
    "csv_ingest": csv_ingest,
    "silver_loans_from_text": silver_from_text("loans"),
    "silver_clickstream_from_text": silver_from_text("clickstream"),
    "silver_attributes_from_text": silver_from_text("attributes"),
    "silver_financials_from_text": silver_from_text("financials"),
    "bronze_rejected_rows": bronze_rejected_rows,
    "bronze_rejected_lines": bronze_rejected_lines,
    "csv_three_headers": csv_three_headers,
    "run_counts": run_counts,
    "attributes_store": attributes_store,
    "month_calendar": month_calendar,
    "silver_loans": loans,
    "silver_dpd_distribution": silver_dpd_distribution,
    "silver_clickstream_clamp": lambda spark, sf_dir: silver_table(spark, sf_dir, "clickstream"),
    "silver_attributes": lambda spark, sf_dir: silver_table(spark, sf_dir, "attributes"),
    "silver_fin_money": financials(S.MONEY_COLUMNS),
    "silver_fin_integers_capped": financials(S.INTEGER_COLUMNS),
    "silver_fin_credit_age": financials(["Credit_History_Age"]),
    "silver_fin_ratios_clean": financials(S.RATIO_COLUMNS),
    "silver_fin_encodings": financials(["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]),
    "silver_fin_engineered": financials(S.ENGINEERED_COLUMNS),
    "gold_labels": labels,
    "gold_engagement": engagement,
    "gold_risk": risk,
    "model_table": model_table,
    "split_assignment": split_assignment,
    "split_policy_by_month": assigned,
    "split_policy_early_gate": split_policy_early_gate,
    "bad_rate_by_mob": lambda spark, sf_dir: metrics.bad_rate_by_mob(loans(spark, sf_dir), CUT_OFF),
    "actual_bads": lambda spark, sf_dir: metrics.actual_bads(loans(spark, sf_dir), CUT_OFF, FINAL_INSTALMENT),
    "label_profile": lambda spark, sf_dir: metrics.label_profile(labels(spark, sf_dir)),
    "auc_by_group": auc_by_group,
    "holdout_auc": holdout_auc,
    "auc_by_snapshot": auc_by_snapshot,
    "auc_trailing_window": auc_trailing_window,
    "train_and_score": train_and_score,
    "training_manifest": training_manifest,
    "store_roundtrip": store_roundtrip,
}
