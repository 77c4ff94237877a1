"""Recency, frequency, monetary value."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.money import average

# Score cuts (best first) and bucket labels.
RECENCY_CUTS = (30, 60, 90, 180)
FREQUENCY_CUTS = (10, 7, 4, 2)
MONETARY_CUTS = (5000, 2000, 1000, 500)
RECENCY_LABELS = ("0-30 days", "31-60 days", "61-90 days", "91-180 days", "180+ days")
FREQUENCY_LABELS = ("10+ orders", "7-9 orders", "4-6 orders", "2-3 orders", "1 order")
MONETARY_LABELS = ("$5000+", "$2000-4999", "$1000-1999", "$500-999", "$0-499")
# Segments in order, with what they ask of the recency, frequency and monetary scores.
SEGMENT_RULES = (
    ("Champions", ">= 4", ">= 4", ">= 4"),
    ("Loyal Customers", ">= 3", ">= 3", ">= 3"),
    ("New Customers", ">= 4", "<= 2", "<= 2"),
    ("At Risk", "<= 2", ">= 3", ">= 3"),
    ("Cant Lose Them", "<= 2", "<= 2", ">= 3"),
    ("Lost", "<= 2", "<= 2", "<= 2"),
    ("Promising", ">= 3", "<= 2", "<= 2"),
    ("Potential Loyalists", ">= 3", None, ">= 3"),
)
NO_SEGMENT = "Others"


def _step(value: Column, cuts: Sequence[int], results: Sequence, below: bool) -> Column:
    """First result whose cut the value meets; the last result catches the rest."""
    chosen = F.lit(results[-1])
    for cut, result in reversed(list(zip(cuts, results))):
        chosen = F.when(value <= cut if below else value >= cut, F.lit(result)).otherwise(chosen)
    return chosen


def rfm_base(customers: DataFrame, as_of: dt.date) -> DataFrame:
    """Customers with orders; recency counts days since the last one."""
    recency = F.date_diff(F.lit(as_of), F.to_date("last_order_date"))
    return customers.filter(F.col("total_orders") > 0).select(
        "customer_id", "customer_name", "customer_email", recency.alias("recency_days"),
        F.col("total_orders").alias("frequency"), F.col("lifetime_value_usd").alias("monetary_usd"),
        "customer_segment")


def rfm_table(customers: DataFrame, as_of: dt.date, limit: int = 20) -> DataFrame:
    top = rfm_base(customers, as_of).orderBy(F.desc("monetary_usd"), "customer_id").limit(limit)
    return top.drop("customer_id")


def _meets(score: Column, rule: str | None) -> Column:
    if rule is None:
        return F.lit(True)
    sign, bound = rule.split()
    return score >= int(bound) if sign == ">=" else score <= int(bound)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """The first rule that all three scores meet names the segment."""
    segment = F.lit(NO_SEGMENT)
    for name, *rules in reversed(SEGMENT_RULES):
        fits = [_meets(score, rule) for score, rule in zip((r, f, m), rules)]
        segment = F.when(fits[0] & fits[1] & fits[2], name).otherwise(segment)
    return segment


def _scored(customers: DataFrame, as_of: dt.date) -> DataFrame:
    base, scores = rfm_base(customers, as_of), (5, 4, 3, 2, 1)
    r = _step(F.col("recency_days"), RECENCY_CUTS, scores, below=True)
    f = _step(F.col("frequency"), FREQUENCY_CUTS, scores, below=False)
    m = _step(F.col("monetary_usd"), MONETARY_CUTS, scores, below=False)
    scored = base.withColumns({"r_score": r, "f_score": f, "m_score": m})
    segment = rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    return scored.withColumns({
        "rfm_code": F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]),
        "rfm_segment": segment})


def rfm_scores(customers: DataFrame, as_of: dt.date) -> DataFrame:
    """Scores, code and segment per customer. The id last in the sort splits the few score values."""
    best = [F.desc(c) for c in ("r_score", "f_score", "m_score")]
    return _scored(customers, as_of).orderBy(*best, "customer_id").select(
        "customer_name", "customer_email", "recency_days", "frequency", "monetary_usd", "r_score",
        "f_score", "m_score", "rfm_code", "rfm_segment", F.col("customer_segment").alias("original_segment"))


def rfm_segment_summary(customers: DataFrame, as_of: dt.date) -> DataFrame:
    return _scored(customers, as_of).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("monetary_usd").alias("total_value_usd"),
        average(F.col("monetary_usd")).alias("avg_value_usd"),
        average(F.col("recency_days")).alias("avg_recency_days"),
        average(F.col("frequency")).alias("avg_frequency"),
    ).orderBy(F.desc("total_value_usd"), "rfm_segment")


def _distribution(base: DataFrame, bucket: Column, name: str, rank: Column) -> DataFrame:
    return base.groupBy(bucket.alias(name)).agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("monetary_usd").alias("total_value_usd"), rank.alias("_rank"))


def recency_distribution(customers: DataFrame, as_of: dt.date) -> DataFrame:
    bucket = _step(F.col("recency_days"), RECENCY_CUTS, RECENCY_LABELS, below=True)
    rows = _distribution(rfm_base(customers, as_of), bucket, "recency_bucket", F.min("recency_days"))
    return rows.orderBy("_rank").drop("_rank")


def frequency_distribution(customers: DataFrame, as_of: dt.date) -> DataFrame:
    bucket = _step(F.col("frequency"), FREQUENCY_CUTS, FREQUENCY_LABELS, below=False)
    rows = _distribution(rfm_base(customers, as_of), bucket, "frequency_bucket", F.min("frequency"))
    return rows.orderBy(F.desc("_rank")).drop("_rank")


def monetary_distribution(customers: DataFrame, as_of: dt.date) -> DataFrame:
    bucket = _step(F.col("monetary_usd"), MONETARY_CUTS, MONETARY_LABELS, below=False)
    rows = _distribution(rfm_base(customers, as_of), bucket, "monetary_bucket", F.min("monetary_usd"))
    return rows.orderBy(F.desc("_rank")).drop("_rank")
