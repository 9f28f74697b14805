"""Date parts, keys and distances.  No function reads the clock: the reference date is an argument."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_date(as_of: date | str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def date_key(column: Column | str) -> Column:
    """20240131 for 31 January 2024."""
    return F.date_format(column, "yyyyMMdd").cast("int")


def weekend(column: Column | str) -> Column:
    """Saturday or Sunday; false for a missing date."""
    return F.coalesce(F.dayofweek(column).isin(1, 7), F.lit(False))


def days_since(last: Column, as_of: date | str | Column) -> Column:
    """Calendar days between a timestamp and the reference date."""
    return F.datediff(_as_date(as_of), last)


def full_days_since(last: Column, as_of: date | str | Column) -> Column:
    """Completed 24-hour periods between a timestamp and midnight of the reference date."""
    return F.timestamp_diff("DAY", last, _as_date(as_of).cast("timestamp")).cast("int")
