"""Date and time column expressions.

Timestamps are ``timestamp_ntz`` so results never depend on the session
time zone.  Invalid parts give null instead of failing the job (ANSI mode
is on by default in Spark 4, where the plain constructors raise).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def incident_timestamp(year, month, day, hour, minute) -> Column:
    """Timestamp at second 0 from five integer parts; null when any part is
    null or the date/time does not exist (Feb 31, hour 24, ...)."""
    return F.try_make_timestamp_ntz(
        years=_col(year), months=_col(month), days=_col(day), hours=_col(hour), mins=_col(minute),
        secs=F.lit(0))


def parse_us_date(c: str | Column) -> Column:
    """``MM/dd/yyyy`` text -> date; null when it does not parse."""
    return F.try_to_date(_col(c), "MM/dd/yyyy")


def date_parts(c: str | Column) -> list[Column]:
    """``year, month, day`` (int) of a date or timestamp column."""
    c = _col(c)
    return [F.year(c).alias("year"), F.month(c).alias("month"), F.dayofmonth(c).alias("day")]


def fractional_hour(hour: str | Column, minute: str | Column) -> Column:
    """``hour + minute / 60`` as double."""
    return _col(hour) + _col(minute) / F.lit(60.0)
