"""Calendar column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: str | Column) -> Column:
    """Integer ``yyyymmdd`` of a date or timestamp (time of day dropped)."""
    d = _col(c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_start(c: str | Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(c).cast("date"), "month")


def is_month_end(c: str | Column) -> Column:
    d = _col(c).cast("date")
    return d == F.last_day(d)


def day_of_week_iso(c: str | Column) -> Column:
    """ISO day of week: Monday = 1 … Sunday = 7."""
    return (F.weekday(_col(c)) + 1).cast("int")


def padded_name(c: str | Column, pattern: str, width: int = 9) -> Column:
    """English month/day name blank-padded to ``width`` characters
    (``pattern`` is ``'MMMM'`` for the month, ``'EEEE'`` for the day)."""
    return F.rpad(F.date_format(_col(c), pattern), width, " ")
