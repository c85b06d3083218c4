"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column

WEEKEND = (5, 6)  # Monday is 0


def day_of_week(ts: Column | str) -> Column:
    return F.weekday(as_column(ts))


def is_weekend(ts: Column | str) -> Column:
    return day_of_week(ts).isin(*WEEKEND)


def calendar_date(ts: Column | str) -> Column:
    return F.to_date(as_column(ts))


def parse_timestamp(text: Column | str, pattern: str | None = None) -> Column:
    """Text to timestamp; unreadable text becomes NULL instead of failing the job."""
    column = as_column(text).cast("string")
    return F.try_to_timestamp(column, F.lit(pattern)) if pattern else F.try_to_timestamp(column)


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes from ``start`` to ``end``, fractional, negative when ``end`` comes first."""
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end)) / F.lit(6e7)
