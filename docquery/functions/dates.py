"""Date and time functions over timestamps without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.functions.nulls import _col

year, month, day, hour, minute, second, day_of_year = F.year, F.month, F.dayofmonth, F.hour, F.minute, F.second, F.dayofyear


def millisecond(c: Column) -> Column:
    return F.date_format(c, "SSS").cast("int")


def microsecond(c: Column) -> Column:
    return F.date_format(c, "SSSSSS").cast("int")


def day_of_week(c: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(c) - 1


def date(c: Column) -> Column:
    """Midnight of the same day, without a zone."""
    return F.date_trunc("day", c).cast("timestamp_ntz")


def difference(unit: str, start, end) -> Column:
    """Whole units from start to end."""
    return F.timestamp_diff(unit, _col(start), _col(end))


def time_of_day(c: Column) -> Column:
    """Milliseconds since midnight."""
    return difference("MILLISECOND", date(c), c)


def total_days(start, end) -> Column:
    return difference("MICROSECOND", start, end) / F.lit(86_400_000_000.0)


def add(unit: str, amount, c) -> Column:
    """YEAR, MONTH, DAY, HOUR, MINUTE, SECOND, MILLISECOND or MICROSECOND; months keep to the month's end."""
    return F.timestamp_add(unit, _col(amount), _col(c))
