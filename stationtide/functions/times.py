"""Time encoding and calendar arithmetic on ``timestamp_ntz`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: stored times count seconds from this instant.
TIME_ORIGIN = "1900-01-01 00:00:00"


def ts(value: str) -> Column:
    """Zone-free timestamp literal."""
    return F.to_timestamp_ntz(F.lit(value))


def to_seconds(column: Column) -> Column:
    return F.timestamp_diff("SECOND", ts(TIME_ORIGIN), column)


def from_seconds(column: Column) -> Column:
    return F.timestamp_add("SECOND", column, ts(TIME_ORIGIN))


def day_of(column: Column) -> Column:
    return column.cast("date")


def month_start(column: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(column.cast("date"), "month")


def year_start(column: Column) -> Column:
    return F.trunc(column.cast("date"), "year")


def period_start(column: Column, size: str) -> Column:
    """Start of the time tile (``month`` or ``year``) holding ``column``, as a date."""
    if size == "month":
        return month_start(column)
    if size == "year":
        return year_start(column)
    raise ValueError(f"time tile size must be 'month' or 'year', got {size!r}")


def period_end(start: Column, size: str) -> Column:
    return F.add_months(start, 1 if size == "month" else 12)


def months_between_dates(first: Column, last: Column) -> Column:
    """Array of month starts from ``first`` to ``last``, both included."""
    return F.sequence(first, last, F.expr("interval 1 month"))
