"""Cohort retention.

Orders shrink to distinct (customer, day) pairs before anything is gathered by customer, so a
customer never weighs more than the days of the calendar, whatever share of the orders they hold.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.functions.dates import months_before, whole_months, year_month
from storelake.functions.money import percent


def purchase_days(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("customer_id").isNotNull()).select("customer_id", "order_date").distinct()


def cohort_activity(days: DataFrame) -> DataFrame:
    """Active customers per cohort month and months since the first purchase.

    The distinct (customer, months) step keeps the window's partitioning, so it does not shuffle.
    """
    first = F.min("order_date").over(Window.partitionBy("customer_id"))
    dated = days.withColumn("first_date", first)
    months = whole_months(F.col("first_date"), F.col("order_date"))
    active = dated.select(
        "customer_id", year_month(F.col("first_date")).alias("cohort_month"), months.alias("months_since_first"),
    ).distinct()
    return active.groupBy("cohort_month", "months_since_first").agg(F.count(F.lit(1)).alias("active_customers"))


def retention(activity: DataFrame) -> DataFrame:
    """Cohort size and rate; the window runs over one row per cohort and month."""
    ordered = Window.partitionBy("cohort_month").orderBy("months_since_first")
    sized = activity.withColumn("cohort_size", F.first("active_customers").over(ordered))
    return sized.withColumn("retention_rate", percent(F.col("active_customers"), F.col("cohort_size")))


def _newest_first(curves: DataFrame) -> DataFrame:
    return curves.orderBy(F.desc("cohort_month"), "months_since_first")


def _since(activity: DataFrame, as_of: dt.date, months: int) -> DataFrame:
    return activity.filter(F.col("cohort_month") >= F.lit(f"{months_before(as_of, months):%Y-%m}"))


def cohort_retention(orders: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    return _newest_first(retention(_since(cohort_activity(purchase_days(orders)), as_of, months)))


def recent_cohort_curves(orders: DataFrame, cohorts: int = 3) -> DataFrame:
    """Curves of the newest cohorts, found among one row per cohort and month."""
    activity = cohort_activity(purchase_days(orders))
    newest = activity.select("cohort_month").distinct().orderBy(F.desc("cohort_month")).limit(cohorts)
    return _newest_first(retention(activity.join(newest, "cohort_month", "left_semi")))


def cohort_curves_for(orders: DataFrame, cohort_months: Sequence[str]) -> DataFrame:
    chosen = cohort_activity(purchase_days(orders)).filter(F.col("cohort_month").isin(list(cohort_months)))
    return _newest_first(retention(chosen))


def _pivot(days: DataFrame, as_of: dt.date, columns: int, months: int) -> DataFrame:
    """One row per cohort, one column per month. Listing the values spares the pivot a scan."""
    rates = retention(_since(cohort_activity(days), as_of, months))
    wide = rates.groupBy("cohort_month").pivot("months_since_first", list(range(columns))).agg(F.max("retention_rate"))
    named = [F.col(str(i)).alias(f"Month {i}") for i in range(columns)]
    return wide.select("cohort_month", *named).orderBy("cohort_month")


def cohort_pivot(orders: DataFrame, as_of: dt.date, columns: int = 5, months: int = 12) -> DataFrame:
    return _pivot(purchase_days(orders), as_of, columns, months)


def cohort_by_segment(orders: DataFrame, customers: DataFrame, as_of: dt.date, segment: str | None = None,
                      columns: int = 5, months: int = 12) -> DataFrame:
    """The pivot for the customers of one segment; None keeps all customers of the dimension."""
    chosen = customers if segment is None else customers.filter(F.col("customer_segment") == segment)
    days = purchase_days(orders).join(chosen.select("customer_id"), "customer_id", "left_semi")
    return _pivot(days, as_of, columns, months)
