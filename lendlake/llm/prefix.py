"""Running totals over whole tables without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, groups: list[str], bucket: str, order: list[Column | str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the earlier rows of the same groups, by ``bucket``, then ``order``.

    Buckets are summed first and their sums are added up per group, so a window only sorts one bucket. ``groups`` and
    ``bucket`` hold no nulls. ``df`` is read twice, so it should be a written table.
    """
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*groups, bucket).agg(F.sum(value).alias("__sum"))
    starts = sums.select(*groups, bucket, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return df.join(starts, [*groups, bucket]).withColumn(name, F.col("__start") + here).drop("__start")
