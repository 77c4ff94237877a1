"""Key figures of the last period against the one before."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.dates import days_before
from storelake.functions.money import half_up_ratio
from storelake.plans.periods import between_days


def kpi_summary(orders: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Both periods in one pass: per customer, then over all, then turned into rows.

    Growth is NULL when the previous value is zero or missing.
    """
    both = between_days(orders, as_of, 2 * days)
    current = F.col("order_date") >= F.lit(days_before(as_of, days))
    n, amount = F.col("order_id").isNotNull(), F.col("amount_usd")
    per_customer = both.groupBy("customer_id").agg(
        F.count_if(current & n).alias("c_orders"), F.count_if(~current & n).alias("p_orders"),
        F.count_if(current).alias("c_rows"), F.count_if(~current).alias("p_rows"),
        F.sum(F.when(current, amount)).alias("c_revenue"), F.sum(F.when(~current, amount)).alias("p_revenue"),
        F.count(F.when(current, amount)).alias("c_priced"), F.count(F.when(~current, amount)).alias("p_priced"))
    known = F.col("customer_id").isNotNull()
    sums = ("c_orders", "p_orders", "c_revenue", "p_revenue", "c_priced", "p_priced")
    one = per_customer.agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count_if(known & (F.col("c_rows") > 0)).alias("c_customers"),
        F.count_if(known & (F.col("p_rows") > 0)).alias("p_customers"))

    def metric(name: str, now, before):
        # Two decimals hold every metric exactly: counts, cents and cents-rounded averages.
        return F.struct(F.lit(name).alias("metric"), now.cast("decimal(28,2)").alias("current_value"),
                        before.cast("decimal(28,2)").alias("previous_value"))

    zero = F.lit(0)
    rows = one.select(F.explode(F.array(
        metric("Total Orders", F.coalesce("c_orders", zero), F.coalesce("p_orders", zero)),
        metric("Unique Customers", F.col("c_customers"), F.col("p_customers")),
        metric("Total Revenue (USD)", F.col("c_revenue"), F.col("p_revenue")),
        metric("Avg Order Value (USD)", half_up_ratio(F.col("c_revenue"), F.col("c_priced")),
               half_up_ratio(F.col("p_revenue"), F.col("p_priced"))))).alias("r")).select("r.*")
    change = F.col("current_value") - F.col("previous_value")
    return rows.withColumn("growth_percentage", half_up_ratio(change * 100, F.col("previous_value")))
