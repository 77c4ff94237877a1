"""Checks of how the data is distributed: concentration, abandonment, conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Popularity tiers as upper ends of the percent rank.
TIERS = ((0.2, "high"), (0.5, "medium"))
REST = "low"


def _magnitude(units: Column) -> Column:
    """Order-preserving bucket number: nine leading bits and the length, under 30,000 values."""
    shift = F.greatest(F.length(F.bin(units)) - F.lit(9), F.lit(0))
    return shift * F.lit(512) + F.call_function("shiftright", units, shift)


def units_percent_rank(items: DataFrame) -> DataFrame:
    """Products grouped by units sold, with the percent rank of each unit count, most sold first.

    A rank over all products in one window would run in one task. Products with equal units share a
    rank, so they are first reduced to one row per unit count. Ranks then run inside buckets of near
    unit counts, and only the bucket totals, a bounded number of rows, meet in one place.
    """
    per_product = items.groupBy("product_id").agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("units"), F.count(F.lit(1)).alias("lines"))
    counted = per_product.groupBy("units").agg(
        F.count(F.lit(1)).alias("products"), F.sum("lines").alias("lines"),
    ).withColumn("bucket", _magnitude(F.col("units")))

    totals = counted.groupBy("bucket").agg(F.sum("products").alias("n"))
    running = F.sum("n").over(Window.orderBy(F.desc("bucket")))
    offsets = totals.select(
        "bucket", (running - F.col("n")).alias("above"), F.sum("n").over(Window.partitionBy()).alias("total"))

    inside = Window.partitionBy("bucket").orderBy(F.desc("units"))
    ranked = counted.withColumn("ahead", F.sum("products").over(inside) - F.col("products")).join(offsets, "bucket")
    rank = (F.col("above") + F.col("ahead")).cast("double") / F.nullif(F.col("total") - 1, F.lit(0))
    return ranked.select("units", "products", "lines", F.coalesce(rank, F.lit(0.0)).alias("percentile"))


def pareto_share(items: DataFrame, top: float = 0.2) -> DataFrame:
    """Share of the units sold by the most sold fifth of the products."""
    tier = F.when(F.col("percentile") <= top, f"Top {top:.0%}").otherwise(f"Bottom {1 - top:.0%}")
    sold = F.sum(F.col("units") * F.col("products")).alias("total_units")
    tiers = units_percent_rank(items).groupBy(tier.alias("product_tier")).agg(sold)
    whole = F.sum("total_units").over(Window.partitionBy())
    return tiers.withColumn("percentage", F.col("total_units") * F.lit(100.0) / whole)


def popularity_mix(items: DataFrame) -> DataFrame:
    """Order lines per popularity tier; lines without a product have none and do not count."""
    tier = F.lit(REST)
    for end, name in reversed(TIERS):
        tier = F.when(F.col("percentile") <= end, name).otherwise(tier)
    sold = items.filter(F.col("product_id").isNotNull())
    return units_percent_rank(sold).groupBy(tier.alias("popularity")).agg(F.sum("lines").alias("items_sold"))


def cart_abandonment(carts: DataFrame) -> DataFrame:
    abandoned = F.count_if(F.col("is_abandoned"))
    return carts.agg(
        F.count(F.lit(1)).alias("total_carts"), abandoned.alias("abandoned"),
        (F.try_divide(abandoned.cast("double"), F.count(F.lit(1))) * 100).alias("abandonment_rate"))


def conversion_funnel(carts: DataFrame) -> DataFrame:
    converted = F.count_if(~F.col("is_abandoned"))
    return carts.groupBy(F.to_date("created_at").alias("date")).agg(
        F.count(F.lit(1)).alias("total_carts"), converted.alias("converted"),
        (converted.cast("double") / F.count(F.lit(1)) * 100).alias("conversion_rate"),
    ).orderBy(F.desc("date"))
