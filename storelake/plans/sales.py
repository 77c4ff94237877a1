"""Sales over time. Orders are summed per day before they meet the date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.dates import moment, year_month
from storelake.functions.money import half_up_ratio
from storelake.plans.periods import between_days

# ``order_id`` is the key of fact_orders (a configured test), so counting it counts orders.


def _per_day(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_date").agg(
        F.count("order_id").alias("orders"), F.sum("amount_usd").alias("revenue"),
        F.count("amount_usd").alias("priced"))


def _on_calendar(rows: DataFrame, dates: DataFrame, *columns: str) -> DataFrame:
    return rows.join(dates.select("date_day", *columns), rows["order_date"] == F.col("date_day"))


def daily_sales_trend(orders: DataFrame, dates: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    daily = _on_calendar(_per_day(between_days(orders, as_of, days)), dates, "day_name")
    return daily.select(
        "date_day", "day_name", F.col("orders").alias("total_orders"),
        F.col("revenue").alias("total_revenue_usd"),
        half_up_ratio(F.col("revenue"), F.col("priced")).alias("avg_order_value_usd"),
    ).orderBy(F.desc("date_day"))


def monthly_revenue(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Two plain aggregations: per month and customer, then per month. No distinct expansion."""
    known = orders.join(dates.select(F.col("date_day").alias("order_date")), "order_date", "left_semi")
    per_customer = known.groupBy(year_month(F.col("order_date")).alias("year_month"), "customer_id").agg(
        F.count("order_id").alias("orders"), F.sum("amount_usd").alias("revenue"),
        F.count("amount_usd").alias("priced"))
    revenue, customers = F.sum("revenue"), F.count("customer_id")
    return per_customer.groupBy("year_month").agg(
        F.sum("orders").alias("total_orders"), customers.alias("unique_customers"),
        revenue.alias("total_revenue_usd"),
        half_up_ratio(revenue, F.sum("priced")).alias("avg_order_value_usd"),
        half_up_ratio(revenue, customers).alias("revenue_per_customer"),
    ).orderBy(F.desc("year_month"))


def weekend_vs_weekday(orders: DataFrame, dates: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    daily = _on_calendar(_per_day(between_days(orders, as_of, days)), dates, "is_weekend")
    period = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return daily.groupBy(period.alias("period_type")).agg(
        F.sum("orders").alias("total_orders"), F.sum("revenue").alias("total_revenue_usd"),
        half_up_ratio(F.sum("revenue"), F.sum("priced")).alias("avg_order_value_usd"))


def _by_month(orders: DataFrame, *aggregates: Column) -> DataFrame:
    month = F.trunc("order_date", "month").alias("month")
    return orders.groupBy(month).agg(*aggregates).orderBy(F.desc("month"))


def monthly_revenue_summary_simple(orders: DataFrame) -> DataFrame:
    return _by_month(orders, F.count("order_id").alias("total_orders"), F.sum("amount_usd").alias("total_revenue_usd"))


def monthly_completed_revenue(orders: DataFrame, status: str = "completed") -> DataFrame:
    done = orders.filter(F.col("status") == status)
    return _by_month(done, F.sum("amount_usd").alias("revenue"), F.count(F.lit(1)).alias("order_count"))


def weekly_seasonality(stg_orders: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Orders and revenue per ISO week (Monday start) in a time range, both ends included."""
    kind = stg_orders.schema["created_at"].dataType
    created = F.col("created_at")
    within = stg_orders.filter((created >= moment(start, kind)) & (created <= moment(end, kind)))
    return within.groupBy(F.trunc(F.to_date("created_at"), "week").alias("week")).agg(
        F.count(F.lit(1)).alias("orders"),
        (F.sum(F.col("amount").cast("decimal(18,0)")) / 100).cast("decimal(28,2)").alias("revenue"),
    ).orderBy("week")


