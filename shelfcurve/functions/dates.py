"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def days_in(begin: Column, end: Column) -> Column:
    """Length of a closed interval of days."""
    return F.datediff(end, begin) + 1


def overlap_share(event_begin: Column, event_end: Column, begin: Column, end: Column) -> Column:
    """Share of the event interval that another interval covers."""
    common = days_in(F.greatest(event_begin, begin), F.least(event_end, end))
    return F.try_divide(common.cast("double"), days_in(event_begin, event_end).cast("double"))


def year_day(day: Column) -> Column:
    """Month and day of month as one number: 1225 is 25 December."""
    return F.month(day) * 100 + F.dayofmonth(day)


def from_serial(serial: Column) -> Column:
    """Spreadsheet day number to date."""
    return F.date_add(F.lit("1900-01-01").cast("date"), (serial - 2).cast("int"))


def month_number(day: Column, first_year: int) -> Column:
    """Number of the month counted from January of ``first_year``, starting at 1."""
    return (F.year(day) - first_year) * 12 + F.month(day)
