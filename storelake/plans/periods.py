"""Relative date filters that also prune the month partitions of stored facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.dates import days_before

MONTH = "order_month"


def between_days(orders: DataFrame, as_of: dt.date, first: int, last: int | None = None,
                 column: str = "order_date") -> DataFrame:
    """Rows from ``first`` days before ``as_of`` on, up to (not including) ``last`` days before."""
    start = days_before(as_of, first)
    rows = orders.filter(F.col(column) >= F.lit(start))
    if MONTH in orders.columns:
        rows = rows.filter(F.col(MONTH) >= F.lit(start.replace(day=1)))
    if last is not None:
        rows = rows.filter(F.col(column) < F.lit(days_before(as_of, last)))
    return rows
