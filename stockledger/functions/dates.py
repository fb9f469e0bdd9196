"""Calendar arithmetic on plain dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockledger.functions.money import as_column


def month_of(date: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(as_column(date), "month")


def month_end(date: Column | str) -> Column:
    return F.last_day(as_column(date))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end; null when either is null."""
    return F.datediff(as_column(end), as_column(start)).cast("long")


def months_from(start: Column | str, date: Column | str) -> Column:
    """Whole months between the months of two dates."""
    start, date = as_column(start), as_column(date)
    return (F.year(date) - F.year(start)) * 12 + F.month(date) - F.month(start)
