"""Default labels, engagement lags, financial-risk features and the model table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendlake import schemas as S
from lendlake.functions.dates import month_start
from lendlake.operators.lookup import ROWS_PER_SLICE, lookup_join


def default_labels(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """One row per loan at ``mob`` months on book: 1 when at least ``dpd`` days late."""
    return loans.where(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        F.when(F.col("dpd") >= dpd, 1).otherwise(0).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def engagement(clicks: DataFrame, snapshots: DataFrame | None = None, feature: str = "fe_1") -> DataFrame:
    """Values of ``feature`` one to six months before each snapshot.

    A customer gets a row for every snapshot with data in any of those six months, in
    ``snapshots`` if given. Repeated rows of a customer and month count once, with the greatest value.

    Calendar months count, not days: a click belongs to its month, and a snapshot keeps its own date but draws on the
    months before its month. Without ``snapshots`` they are the first days of months. Undated clicks and snapshots count for nothing.

    Each month is sent to its customer once, instead of six times to six snapshots. A
    customer then has at most one row per month of the calendar, and the row of month m
    writes the snapshots for which m is the latest month with data.
    """
    dated = clicks.where(F.col("snapshot_date").isNotNull()).withColumn("snapshot_date", month_start(F.col("snapshot_date")))
    monthly = dated.groupBy(*S.KEY).agg(F.max(feature).alias("value"))
    index = F.year("snapshot_date") * 12 + F.month("snapshot_date")
    by_month = W.partitionBy("Customer_ID").orderBy("month")
    last = S.LAGS[-1]
    history = [F.col("value")] + [F.max("value").over(by_month.rangeBetween(-back, -back)) for back in range(1, last)]
    dated = monthly.withColumn("month", index).select(
        "Customer_ID",
        "snapshot_date",
        F.array(*history).alias("history"),
        F.least(F.lit(last), F.lead("month").over(by_month) - F.col("month")).alias("ahead"),
    )
    written = dated.select(
        "Customer_ID",
        "snapshot_date",
        "history",
        F.explode(F.sequence(F.lit(1), F.col("ahead"))).alias("ahead"),
    ).select(
        "Customer_ID",
        F.add_months("snapshot_date", F.col("ahead")).alias("snapshot_date"),
        *[F.get("history", F.lit(lag) - F.col("ahead")).alias(f"click_{lag}m") for lag in S.LAGS],
    )
    if snapshots is None:
        return written
    month = month_start(F.col("snapshot_date")).alias("month")
    calendar = snapshots.select("snapshot_date", month).distinct()
    by_month = written.withColumnRenamed("snapshot_date", "month")
    return by_month.join(F.broadcast(calendar), "month").select(*S.KEY, *S.ENGAGEMENT_COLUMNS)


def risk_features(financials: DataFrame) -> DataFrame:
    return financials.select(*S.KEY, *S.RISK_COLUMNS)


def model_table(
    labels: DataFrame, engaged: DataFrame, risk: DataFrame, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Labels with both feature sets; as many rows as labels, always the same columns."""
    return lookup_join(labels, [engaged], [risk], S.KEY, [F.col("loan_id")], rows_per_slice)
