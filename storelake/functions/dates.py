"""Calendar helpers. Nothing here reads the clock: callers pass ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole_months(start: Column, end: Column) -> Column:
    """Completed months between two dates (``start <= end``).

    ``add_months`` clamps to the month end, so Jan 31 -> Feb 29 counts as one completed month.
    """
    n = (F.year(end) - F.year(start)) * F.lit(12) + F.month(end) - F.month(start)
    return n - F.when(F.add_months(start, n) > end, 1).otherwise(0)


def iso_weekday(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + F.lit(1)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def moment(value: dt.datetime | str, kind: T.DataType) -> Column:
    """A point in time as a literal of a column's type.

    A wall-clock time for a column without a zone must not pass through the session's zone.
    """
    if isinstance(value, dt.datetime) and isinstance(kind, T.TimestampNTZType):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(value).cast(kind)


def moment_text(column: Column, kind: T.DataType) -> Column:
    """A time as text that ``moment`` turns back into exactly that time in any session."""
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return column.cast("string")


def days_before(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)


def months_before(as_of: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` before ``as_of``."""
    index = as_of.year * 12 + as_of.month - 1 - months
    return dt.date(index // 12, index % 12 + 1, 1)
