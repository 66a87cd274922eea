"""First-of-month calendars and trailing windows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


def month_start(column: Column) -> Column:
    return F.trunc(column, "MM")


def months_between_bounds(first: Column, last: Column) -> Column:
    """One row per first-of-month date from the month of ``first`` up to ``last``."""
    return F.explode(F.sequence(month_start(first), last, F.expr("interval 1 month")))


def month_calendar(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """First-of-month dates, both ends included, as a one-column DataFrame."""
    first, last = F.lit(as_date(start)), F.lit(as_date(end))
    return spark.range(1).select(months_between_bounds(first, last).alias("snapshot_date"))


def month_list(start: date | str, end: date | str) -> list[date]:
    """The same calendar as Python dates, to name the months of a backfill."""
    start, end = as_date(start), as_date(end)
    count = (end.year - start.year) * 12 + end.month - start.month + 1
    first = start.year * 12 + start.month - 1
    return [date(m // 12, m % 12 + 1, 1) for m in range(first, first + max(count, 0))]


def shift_months(day: date, months: int) -> date:
    """A first-of-month date moved by whole months."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, day.day)


def trailing_window(end: date | str, days: int = 30) -> tuple[date, date]:
    end = as_date(end)
    return end - timedelta(days=days), end
