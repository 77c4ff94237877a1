"""Star schema built from staging DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.functions.dates import iso_weekday
from storelake.functions.money import MONEY, dollars
from storelake.operators.joins import expected_small, left_join_found, left_join_optional

# Default date spine, segment thresholds and low-stock limit.
SPINE = (dt.date(2020, 1, 1), dt.date(2030, 12, 31))
SEGMENTS = ((10, "Champions"), (5, "Loyal"), (2, "Potential Loyalists"), (1, "New Customers"))
NO_ORDERS_SEGMENT = "Dormant"
LOW_STOCK = 10


def fact_orders(orders: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Orders in dollars with their line count, 0 for an order without lines.

    ``counts`` holds one row per order: lines are counted before the join, so a huge order meets it
    as one row. Without it the orders carry ``item_count`` themselves and nothing shuffles.
    """
    counted = orders if counts is None else orders.join(counts, "order_id", "left")
    return counted.select(
        "order_id", "customer_id", dollars(F.col("amount")).alias("amount_usd"), "currency", "status",
        F.to_date("created_at").alias("order_date"), "created_at", "updated_at",
        F.coalesce("item_count", F.lit(0)).cast("bigint").alias("item_count"),
    )


def fact_order_items(
    items: DataFrame, orders: DataFrame | None, variants: DataFrame, products: DataFrame,
) -> DataFrame:
    """Lines priced at the variant's current price, else the product's, else zero.

    ``orders`` gives the times of lines staged without them. Where neither price list is small enough to broadcast,
    each would move every line: then prices are looked up once for each pair of references that occurs, and the lines
    move once, to meet their pair.
    """
    dated = items if orders is None else items.join(orders.select("order_id", "created_at", "updated_at"), "order_id")
    variant_price = variants.select("variant_id", F.col("price_usd").alias("variant_price"))
    product_price = products.select("product_id", F.col("price_usd").alias("product_price"))
    unit = F.coalesce("variant_price", "product_price", F.lit(0).cast(MONEY))

    def with_prices(rows: DataFrame, row_key: str) -> DataFrame:
        return left_join_optional(rows, variant_price, "variant_id", row_key).join(product_price, "product_id", "left")

    if expected_small(variant_price) or expected_small(product_price):
        priced = with_prices(dated, "order_item_id")
    else:
        pairs = items.select("product_id", "variant_id").distinct()
        found = with_prices(pairs, "product_id").select("product_id", "variant_id", unit.alias("_unit"))
        priced = left_join_found(dated, found, ["product_id", "variant_id"], "order_item_id")
        unit = F.coalesce("_unit", F.lit(0).cast(MONEY))
    return priced.select(
        "order_item_id", "order_id", "product_id", "variant_id", "quantity",
        unit.alias("unit_price_usd"), (F.col("quantity") * unit).cast(MONEY).alias("line_total_usd"),
        "created_at", "updated_at",
    )


def fact_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "transaction_id", "order_id", "customer_id", dollars(F.col("amount")).alias("amount_usd"),
        "currency", "payment_method", "status", F.to_date("created_at").alias("transaction_date"),
        "created_at", "updated_at",
    )


def customer_segment(total_orders: Column) -> Column:
    segment = F.lit(NO_ORDERS_SEGMENT)
    for least, name in reversed(SEGMENTS):
        segment = F.when(total_orders >= least, name).otherwise(segment)
    return segment


def dim_customers(customers: DataFrame, orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Customers with lifetime metrics. ``order_id`` is the key of ``orders``, so a count suffices."""
    history = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("n_orders"), F.sum("amount_usd").alias("value"),
        F.min("created_at").alias("first_order_date"), F.max("created_at").alias("last_order_date"),
    )
    total = F.coalesce("n_orders", F.lit(0).cast("bigint"))
    since = F.coalesce("first_order_date", "created_at")
    return customers.join(history, "customer_id", "left").select(
        "customer_id", F.col("name").alias("customer_name"), F.col("email").alias("customer_email"),
        since.alias("customer_since"),
        F.date_diff(F.lit(as_of), F.to_date(since)).alias("customer_lifetime_days"),
        total.alias("total_orders"),
        F.coalesce("value", F.lit(0).cast(MONEY)).alias("lifetime_value_usd"),
        "first_order_date", "last_order_date", customer_segment(total).alias("customer_segment"),
        "updated_at",
    )


def dim_products(products: DataFrame, low_stock: int = LOW_STOCK) -> DataFrame:
    stock = F.coalesce("inventory", F.lit(0))
    return products.select(
        "product_id", F.col("title").alias("product_name"), F.col("slug").alias("product_slug"),
        "price_usd", "inventory", "created_at", "updated_at", (stock > 0).alias("is_in_stock"),
        ((stock > 0) & (stock <= low_stock)).alias("is_low_stock"),
    )


def dim_categories(categories: DataFrame) -> DataFrame:
    return categories.select("category_id", "category_name", "category_slug", "created_at", "updated_at")


def bridge_product_categories(product_categories: DataFrame) -> DataFrame:
    return product_categories.select("product_id", "category_id").filter(F.col("category_id").isNotNull())


def date_bounds(spark: SparkSession, start: dt.date = SPINE[0], end: dt.date = SPINE[1]) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def covering_years(dates: DataFrame, column: str) -> DataFrame:
    """Bounds of the whole years that contain every date of a column."""
    low, high = F.min(column), F.max(column)
    return dates.agg(F.make_date(F.year(low), F.lit(1), F.lit(1)).alias("start"),
                     F.make_date(F.year(high), F.lit(12), F.lit(31)).alias("end"))


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day from ``start`` to ``end`` of a one-row frame."""
    day = F.col("date_day")
    weekend, month = iso_weekday(day) >= 6, F.month(day)
    return bounds.select(F.explode(F.sequence("start", "end")).alias("date_day")).select(
        day.alias("date_key"), day, F.year(day).alias("year"), F.quarter(day).alias("quarter"),
        month.alias("month"), F.dayofmonth(day).alias("day"), iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"), F.weekofyear(day).alias("week_of_year"),
        weekend.alias("is_weekend"), month.isin(11, 12).alias("is_holiday_season"),
    )
