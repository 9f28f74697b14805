"""Running figures over a table with one row per day.

The moving averages and the day-over-day change have no partition column, so they run in one task.  That
is bounded by the calendar, not by the data: a century of days is 36,525 rows.  Call them only on tables
already aggregated to one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import average


def year_to_date(column: str, year: str, day: str) -> Column:
    window = Window.partitionBy(year).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(column).over(window)


def moving_average(column: str, day: str, rows: int) -> Column:
    """Average over the last ``rows`` rows present; a day without a row is not a zero."""
    window = Window.orderBy(day).rowsBetween(1 - rows, Window.currentRow)
    return average(F.sum(column).over(window), F.count(column).over(window))


def change_from_previous(column: str, day: str) -> Column:
    return F.col(column) - F.lag(column).over(Window.orderBy(day))


def rank_in_month(column: str, year: str, month: str) -> Column:
    """Rank among the days of one month: at most 31 rows per group."""
    return F.rank().over(Window.partitionBy(year, month).orderBy(F.col(column).desc_nulls_last()))
