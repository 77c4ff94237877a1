"""Product and category performance, stock alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.money import average, half_up_ratio

UNCATEGORIZED = "Uncategorized"
# Lines whose orders one task tells apart.
LINES_PER_TASK = 300_000


def category_names(bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """Sorted, comma-joined category names per product (as many as one document lists)."""
    named = bridge.join(categories.select("category_id", "category_name"), "category_id")
    return named.groupBy("product_id").agg(
        F.array_join(F.array_sort(F.collect_list("category_name")), ", ").alias("category_names"))


def _grouped(rows: DataFrame, key: str, *labels: str) -> tuple[DataFrame, DataFrame]:
    """Number the distinct labels of a dimension by the smallest key that has them.

    Gives ``key, group_id`` and ``group_id, labels``. Lines then shuffle on one number rather than on
    label texts. Labels may be NULL.
    """
    groups = rows.groupBy(*labels).agg(F.min(key).alias("group_id"))
    named = groups.toDF(*[f"_{c}" for c in labels], "group_id")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in labels])
    return rows.join(named, same).select(key, "group_id"), groups


def top_products(items: DataFrame, products: DataFrame, bridge: DataFrame, categories: DataFrame,
                 limit: int = 10) -> DataFrame:
    """Grouped by name, not by id: products that share a name and categories are one line."""
    named = products.select("product_id", "product_name").join(category_names(bridge, categories), "product_id", "left")
    ids, groups = _grouped(named, "product_id", "product_name", "category_names")
    sold = items.join(ids, "product_id").groupBy("group_id").agg(
        F.count_distinct("order_id").alias("times_ordered"), F.sum("quantity").alias("total_quantity_sold"),
        F.sum("line_total_usd").alias("total_revenue_usd"),
        average(F.col("unit_price_usd")).alias("avg_unit_price_usd"))
    return sold.join(groups, "group_id").select(
        "product_name", F.coalesce("category_names", F.lit(UNCATEGORIZED)).alias("categories"),
        "times_ordered", "total_quantity_sold", "total_revenue_usd", "avg_unit_price_usd",
    ).orderBy(F.desc("total_revenue_usd"), "product_name", "categories").limit(limit)


def category_performance(items: DataFrame, bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """A line of a product with several categories counts in each of them.

    Amounts are added up per product first. Only the ids of groups and orders are held to count different orders.
    """
    ids, groups = _grouped(categories, "category_id", "category_name")
    linked = bridge.join(ids, "category_id").select("product_id", "group_id")
    per_product = items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), F.sum("line_total_usd").alias("total"), F.count("line_total_usd").alias("priced"))
    total = F.sum("total").cast("decimal(28,2)")
    sums = per_product.join(linked, "product_id").groupBy("group_id").agg(
        F.sum("units").alias("items_sold"), total.alias("total_revenue_usd"),
        half_up_ratio(total, F.sum("priced")).alias("avg_line_value_usd"))
    held = items.select("product_id", "order_id").join(linked, "product_id").select("group_id", "order_id")
    # Dealt before they are told apart, so that the ids a task holds do not grow with the lines.
    tasks = 1 + items.count() // LINES_PER_TASK
    if tasks > 1:
        held = held.repartition(tasks, "group_id", "order_id")
    sold = held.distinct().groupBy("group_id").agg(F.count("order_id").alias("total_orders")).join(sums, "group_id")
    return sold.join(groups, "group_id").select(
        "category_name", "total_orders", "items_sold", "total_revenue_usd", "avg_line_value_usd",
    ).orderBy(F.desc("total_revenue_usd"), "category_name")


def inventory_alert(products: DataFrame, bridge: DataFrame, categories: DataFrame) -> DataFrame:
    short = products.filter(F.col("is_low_stock") | ~F.col("is_in_stock"))
    named = short.join(category_names(bridge, categories), "product_id", "left")
    return named.select(
        "product_name", F.coalesce("category_names", F.lit(UNCATEGORIZED)).alias("categories"),
        "inventory", "price_usd", "is_low_stock", "is_in_stock",
    ).orderBy("inventory", "product_name", "categories", "price_usd")


def potential_inventory_value(products: DataFrame) -> DataFrame:
    value = (F.col("price_usd") * F.col("inventory")).cast("decimal(28,2)")
    return products.select("product_id", "product_name", "inventory", "price_usd", value.alias("potential_value_usd"))


def top_selling_units(items: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Lines are summed per product before names are joined, then names are merged."""
    per_product = items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), F.sum("line_total_usd").alias("total"))
    named = per_product.join(products.select("product_id", "product_name"), "product_id")
    return named.groupBy("product_name").agg(
        F.sum("units").alias("units_sold"), F.sum("total").alias("revenue"),
    ).orderBy(F.desc("revenue"), "product_name").limit(limit)


def top_products_catalog_price(items: DataFrame, stg_products: DataFrame, limit: int = 10) -> DataFrame:
    """Revenue at the product's catalogue price, whatever variant was sold."""
    per_product = items.groupBy("product_id").agg(
        F.count("order_item_id").alias("order_count"), F.sum("quantity").alias("units_sold"))
    priced = per_product.join(stg_products.select("product_id", "title", "price_usd"), "product_id")
    revenue = (F.col("units_sold").cast("decimal(20,0)") * F.col("price_usd")).cast("decimal(28,2)")
    ranked = priced.withColumn("revenue", revenue).orderBy(F.desc("revenue"), "product_id").limit(limit)
    return ranked.select("title", "order_count", "units_sold", "revenue")
