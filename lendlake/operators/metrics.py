"""Bad-rate curves, label profiles and exact areas under the ROC curve."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendlake.schemas import SNAPSHOT

# Bits of the order key below the binary point, and how many of them are left to the
# second level. A level-one node has at most 2**21 children, the top level about as
# many nodes, and a relative width of 2**-30 holds fewer than 2**23 distinct doubles.
KEY_BITS = 30
FINE_BITS = 21


def dpd_flag(df: DataFrame, dpd: int = 30) -> DataFrame:
    return df.withColumn("dpd_flag", F.when(F.col("dpd") >= dpd, 1).otherwise(0))


def started_before(loans: DataFrame, cut_off: date | str) -> DataFrame:
    return loans.where(F.col("loan_start_date") < F.lit(cut_off).cast("date"))


def bad_rate_by_mob(loans: DataFrame, cut_off: date | str, dpd: int = 30) -> DataFrame:
    """Share of rows at least ``dpd`` days late, by months on book."""
    return (
        dpd_flag(started_before(loans, cut_off), dpd)
        .groupBy("mob")
        .agg(F.avg("dpd_flag").alias("bad_rate"), F.count(F.lit(1)).alias("row_count"))
        .orderBy("mob")
    )


def actual_bads(loans: DataFrame, cut_off: date | str, final_instalment: int = 10, dpd: int = 30) -> DataFrame:
    """Rows at the final instalment of loans that started before ``cut_off``."""
    flagged = dpd_flag(started_before(loans, cut_off), dpd)
    return flagged.where(F.col("installment_num") == final_instalment)


def label_profile(labels: DataFrame) -> DataFrame:
    """Rows and default rate by snapshot and label definition."""
    return labels.groupBy(SNAPSHOT, "label_def").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("label").alias("bad_count"),
        F.avg("label").alias("bad_rate"),
    )


def order_key(score: Column) -> Column:
    """Whole number that never falls when the score rises, fine on a relative scale."""
    size = F.log2(F.abs(score)) + 1076
    signed = F.when(score > 0, size).when(score < 0, -size).otherwise(0.0)
    bounded = F.when(F.isnan(score), F.lit(2102.0)).otherwise(F.least(F.greatest(signed, F.lit(-2101.0)), F.lit(2101.0)))
    return F.floor(bounded * 2**KEY_BITS)


def _merge_level(df: DataFrame, parents: list[str], order: str) -> DataFrame:
    """Pairs won between the children of each parent, added up into the parent."""
    before = W.partitionBy(*parents).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(before), F.lit(0))
    won = F.col("won") + F.col("pos").cast("double") * below
    return (
        df.select(*parents, "pos", "neg", won.alias("won"))
        .groupBy(*parents)
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    )


def score_counts(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Bad and good rows of each group by distinct score; rows without a label or score do not take part.

    These counts add up: those of any set of groups, merged, hold all that ``auc_of_counts`` needs.
    """
    value = F.col(score).cast("double")
    known = df.where(F.col(label).isNotNull() & value.isNotNull())
    counts = [F.count_if(F.col(label) == 1).alias("bads"), F.count_if(F.col(label) != 1).alias("goods")]
    return known.groupBy(*(by or []), value.alias("score")).agg(*counts)


def _area(leaves: DataFrame, by: list[str], name: str) -> DataFrame:
    """The area of each group; ``leaves`` has one row per group and score."""
    leaves = (
        leaves.select(*by, F.col("score").alias("_score"), F.col("bads").alias("pos"), F.col("goods").alias("neg"))
        .withColumn("_fine", order_key(F.col("_score")))
        .withColumn("_coarse", F.shiftright("_fine", FINE_BITS))
        .withColumn("won", F.col("pos").cast("double") * F.col("neg") / 2)
    )
    fine = _merge_level(leaves, [*by, "_coarse", "_fine"], "_score")
    coarse = _merge_level(fine, [*by, "_coarse"], "_fine")
    total = _merge_level(coarse, by, "_coarse")
    pairs = F.col("pos").cast("double") * F.col("neg")
    return total.select(*by, F.try_divide("won", pairs).alias(name))


def auc_of_counts(counts: DataFrame, by: list[str] | None = None, name: str = "auc") -> DataFrame:
    """``auc`` from ``score_counts`` of finer groups than ``by``, merged; equal to the area over their rows."""
    by = by or []
    merged = counts.groupBy(*by, "score").agg(F.sum("bads").alias("bads"), F.sum("goods").alias("goods"))
    return _area(merged, by, name)


def auc(df: DataFrame, label: str, score: str, by: list[str] | None = None, name: str = "auc") -> DataFrame:
    """Exact area under the ROC curve of each group; ties count half.

    The area is the share of (bad, good) pairs in which the bad row scores higher. Rows
    are first reduced to one per distinct score. Scores then form a tree of three
    levels, and a pair is counted at the node where its two scores part, so no running
    sum goes over a whole group: each has at most a few million rows, however many
    scores a group holds. Rows without a label or score do not take part; a group
    with only one class gives NULL.
    """
    by = by or []
    return _area(score_counts(df, label, score, by), by, name)


def auc_by_snapshot(
    predictions: DataFrame, start: date | str, end: date | str, label: str = "label", score: str = "probability"
) -> DataFrame:
    """Area per snapshot from ``start`` to ``end``, both included, in date order."""
    in_range = predictions.where(F.col(SNAPSHOT).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return auc(in_range, label, score, [SNAPSHOT], "test_auc").orderBy(SNAPSHOT)
