"""Dates with uncertainty, gaps and freshness; all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def interval(text: Column) -> tuple[Column, Column]:
    """(first day, last day) of a year, month, day or ISO timestamp given as text; null if it is none of them."""
    year, month = text.rlike(r"^\d{4}$"), text.rlike(r"^\d{4}-\d{2}$")
    first = F.when(year, F.try_to_date(F.concat(text, F.lit("-01-01")))).when(month, F.try_to_date(F.concat(text, F.lit("-01")))).otherwise(F.try_to_date(F.substring(text, 1, 10)))
    last = F.when(year, F.add_months(first, 12) - F.expr("INTERVAL 1 DAY")).when(month, F.last_day(first)).otherwise(first)
    return first, last.cast("date")


def max_gap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """The worst-case number of days between two intervals."""
    return F.greatest(F.abs(F.datediff(a0, b1)), F.abs(F.datediff(a1, b0)))


def min_gap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """The best-case number of days; 0 if they overlap."""
    return F.greatest(F.datediff(b0, a1), F.datediff(a0, b1), F.lit(0))


def freshness(at: Column, now: Column, stale_s: int = 5400, future_s: int = 300) -> Column:
    """unknown (no time, or too far in the future), stale or recent."""
    age = F.unix_timestamp(now) - F.unix_timestamp(at)
    return F.when(at.isNull() | (age < -future_s), "unknown").when(age > stale_s, "stale").otherwise("recent")
