"""Payment outcomes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.functions.money import percent
from storelake.plans.periods import between_days


def payment_success_rate(transactions: DataFrame) -> DataFrame:
    """Share of each status. The window sees one row per status."""
    by_status = transactions.groupBy("status").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("amount_usd").alias("total_amount_usd"))
    whole = F.sum("transaction_count").over(Window.partitionBy())
    shares = by_status.withColumn("percentage", percent(F.col("transaction_count"), whole))
    return shares.orderBy(F.desc("transaction_count"), "status")


def daily_transactions(transactions: DataFrame, dates: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    recent = between_days(transactions, as_of, days, column="transaction_date")
    daily = recent.groupBy(F.col("transaction_date").alias("date_day")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(F.col("status") == "succeeded").alias("successful_transactions"),
        F.count_if(F.col("status") == "failed").alias("failed_transactions"),
        F.sum("amount_usd").alias("total_amount_usd"))
    return daily.join(dates.select("date_day"), "date_day", "left_semi").orderBy(F.desc("date_day"))
