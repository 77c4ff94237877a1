"""Customer value, acquisition, activity and gaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.functions.dates import year_month
from storelake.functions.money import average, half_up_ratio
from storelake.plans.periods import between_days

# Spending cuts in dollars and order-count cuts.
HIGH_SPEND, LOW_SPEND, VIP_SPEND = 2000, 500, 5000
VIP_ORDERS, REGULAR_ORDERS = 10, 3


def segment_overview(customers: DataFrame) -> DataFrame:
    value = F.sum("lifetime_value_usd")
    return customers.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("total_orders").alias("total_orders"),
        value.alias("total_ltv_usd"), average(F.col("lifetime_value_usd")).alias("avg_ltv_usd"),
        average(F.col("total_orders")).alias("avg_orders_per_customer"),
    ).orderBy(F.desc("total_ltv_usd"), "customer_segment")


def top_customers_ltv(customers: DataFrame, limit: int = 20) -> DataFrame:
    top = customers.orderBy(F.desc("lifetime_value_usd"), "customer_id").limit(limit)
    return top.select(
        "customer_name", "customer_email", "customer_segment", "total_orders", "lifetime_value_usd",
        F.to_date("first_order_date").alias("first_order_date"),
        F.to_date("last_order_date").alias("last_order_date"), "customer_lifetime_days")


def customer_acquisition(customers: DataFrame) -> DataFrame:
    return customers.groupBy(year_month(F.col("customer_since")).alias("acquisition_month")).agg(
        F.count(F.lit(1)).alias("new_customers"), F.sum("total_orders").alias("total_orders_from_cohort"),
        F.sum("lifetime_value_usd").alias("cohort_ltv_usd"),
        average(F.col("lifetime_value_usd")).alias("avg_customer_ltv_usd"),
    ).orderBy(F.desc("acquisition_month"))


def active_customers(orders: DataFrame, as_of: dt.date, days: int = 90, status: str = "completed") -> DataFrame:
    """Customers with a completed order in the previous ``days`` whole days, with their revenue."""
    recent = between_days(orders, as_of, days, 0).filter(F.col("status") == status)
    revenue = recent.filter(F.col("customer_id").isNotNull()).groupBy("customer_id")
    return revenue.agg(F.lit(1).alias("distinct_customers"), F.sum("amount_usd").alias("revenue_usd"))


def spend_tiers(active: DataFrame) -> DataFrame:
    revenue = F.col("revenue_usd")
    tier = F.when(revenue > HIGH_SPEND, "High").when(revenue >= LOW_SPEND, "Medium").otherwise("Low")
    return active.select("customer_id", "revenue_usd", tier.alias("spend_tier"), (revenue > VIP_SPEND).alias("is_vip"))


def category_gap(active: DataFrame, orders: DataFrame, items: DataFrame, bridge: DataFrame, category_id: int) -> DataFrame:
    """Active customers who never bought from a category. Buyers are reduced to ids at each step."""
    in_category = bridge.filter(F.col("category_id") == category_id).select("product_id").distinct()
    with_category = items.join(in_category, "product_id", "left_semi").select("order_id").distinct()
    buyers = orders.join(with_category, "order_id", "left_semi").select("customer_id").distinct()
    return active.join(buyers, "customer_id", "left_anti").select("customer_id", "revenue_usd")


def lapsed_customers(orders: DataFrame, as_of: dt.date, recent: int = 90, before: int = 180,
                     status: str = "completed") -> DataFrame:
    """Active between ``before`` and ``recent`` days ago and not since: one pass over both periods."""
    window = between_days(orders, as_of, before, 0).filter(F.col("status") == status)
    last = window.filter(F.col("customer_id").isNotNull()).groupBy("customer_id")
    lapsed = last.agg(F.max("order_date").alias("last_order_date"))
    return lapsed.filter(F.col("last_order_date") < F.lit(as_of - dt.timedelta(days=recent)))


def customer_ltv_model(customers: DataFrame, orders: DataFrame, as_of: dt.date, status: str = "completed") -> DataFrame:
    done = orders.filter(F.col("status") == status).groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), F.sum("amount_usd").alias("lifetime_value"),
        average(F.col("amount_usd")).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))
    who = customers.select("customer_id", "customer_email", "customer_since")
    total, idle = F.col("total_orders"), F.date_diff(F.lit(as_of), F.col("last_order_date"))
    segment = F.when(total == 1, "One-time").when(total.between(2, 5), "Regular").when(total > 5, "Loyal")
    status_now = F.when(idle > 90, "At Risk").when(idle > 30, "Inactive").otherwise("Active")
    return who.join(done, "customer_id").select(
        "customer_id", "customer_email", "customer_since", "total_orders", "lifetime_value",
        "avg_order_value", "first_order_date", "last_order_date", idle.alias("days_since_last_order"),
        segment.alias("customer_segment"), status_now.alias("engagement_status"))


def repeat_customers(orders: DataFrame, status: str = "completed") -> DataFrame:
    done = orders.filter(F.col("status") == status).groupBy("customer_id")
    counts = done.agg(F.count(F.lit(1)).alias("order_count"), F.sum("amount_usd").alias("lifetime_value"))
    return counts.filter("order_count > 1")


def _order_segment(total):
    return F.when(total >= VIP_ORDERS, "VIP").when(total >= REGULAR_ORDERS, "Regular").otherwise("New")


def order_count_segments(stg_orders: DataFrame) -> DataFrame:
    """Share of customers per order-count segment. The window sees one row per segment."""
    per_customer = stg_orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_orders"))
    sized = per_customer.groupBy(_order_segment(F.col("total_orders")).alias("segment")).agg(F.count(F.lit(1)).alias("count"))
    whole = F.sum("count").over(Window.partitionBy())
    return sized.withColumn("percentage", F.col("count") * F.lit(100.0) / whole)


def customer_lifetime_value(users: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Every user, also without orders (NULL value), dearest first."""
    per_customer = stg_orders.groupBy("customer_id").agg(
        F.count("order_id").alias("n"), F.sum(F.col("amount").cast("decimal(18,0)")).alias("cents"))
    joined = users.select(F.col("id").alias("customer_id"), "email").join(per_customer, "customer_id", "left")
    total = F.coalesce("n", F.lit(0))
    return joined.orderBy(F.desc_nulls_last("cents"), "customer_id").select(
        "email", total.alias("total_orders"), half_up_ratio(F.col("cents"), F.lit(100)).alias("lifetime_value"),
        _order_segment(total).alias("segment"))
