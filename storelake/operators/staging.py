"""Typed, flat projections of the raw collections. All are narrow: no shuffle.

A damaged id or quantity is an error, not a guest or an unknown product; only category ids are read leniently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.documents import ref_id, string_list
from storelake.functions.money import dollars

# Only ids are read from a populated relation, so the parser skips the rest of it.
_ITEM = "array<struct<id string, product struct<id string>, variant struct<id string>, quantity string>>"
_ITEM_BARE = "array<struct<id string, product string, variant string, quantity string>>"


def _stamps() -> list[Column]:
    return [F.col("createdAt").alias("created_at"), F.col("updatedAt").alias("updated_at")]


def _line_count() -> Column:
    """Length of the items list, measured without parsing its elements."""
    return F.coalesce(F.json_array_length("items"), F.lit(0)).cast("bigint")


def stg_orders(orders: DataFrame, accept_bare: bool = False, count_lines: bool = False) -> DataFrame:
    """``count_lines`` adds ``item_count``, for documents that hold all lines of their order."""
    return orders.select(
        F.col("id").alias("order_id"), ref_id(F.col("customer"), accept_bare, strict=True).alias("customer_id"),
        "amount", "currency", "status", *_stamps(), *([_line_count().alias("item_count")] if count_lines else []),
    )


def stg_order_items(orders: DataFrame, accept_bare: bool = False, keep_stamps: bool = False) -> DataFrame:
    """One row per element of the items list; a NULL or empty list gives none.

    ``keep_stamps`` carries the order's own times along, which spares a join back to the order.
    """
    items = F.from_json("items", _ITEM_BARE if accept_bare else _ITEM)
    stamps = _stamps() if keep_stamps else []
    lines = orders.select(F.col("id").alias("order_id"), *stamps, F.explode(items).alias("item"))

    def reference(name: str) -> Column:
        relation = F.col(f"item.{name}")
        return ref_id(relation, True, strict=True) if accept_bare else relation["id"].cast("bigint")

    return lines.select(
        F.col("item.id").alias("order_item_id"), "order_id",
        reference("product").alias("product_id"), reference("variant").alias("variant_id"),
        F.col("item.quantity").cast("int").alias("quantity"), *(["created_at", "updated_at"] if keep_stamps else []),
    )


def line_counts(fragments: DataFrame) -> DataFrame:
    """``order_id, item_count`` over documents that hold some lines of an order each."""
    return fragments.groupBy(F.col("id").alias("order_id")).agg(F.sum(_line_count()).alias("item_count"))


def stg_transactions(transactions: DataFrame, accept_bare: bool = False) -> DataFrame:
    return transactions.select(
        F.col("id").alias("transaction_id"), ref_id(F.col("order"), accept_bare, strict=True).alias("order_id"),
        ref_id(F.col("customer"), accept_bare, strict=True).alias("customer_id"), "amount", "currency",
        F.col("paymentMethod").alias("payment_method"), "status", *_stamps(),
    )


def stg_carts(carts: DataFrame, accept_bare: bool = False) -> DataFrame:
    """A guest cart has no customer; a cart without a purchase time is abandoned."""
    return carts.select(
        F.col("id").alias("cart_id"), ref_id(F.col("customer"), accept_bare, strict=True).alias("customer_id"),
        "currency", "subtotal", F.col("purchasedAt").alias("purchased_at"), *_stamps(),
        F.col("purchasedAt").isNull().alias("is_abandoned"),
    )


def _priced() -> list[Column]:
    cents = F.col("priceInUSD")
    return [cents.alias("price_in_cents"), dollars(cents).alias("price_usd"), F.col("inventory")]


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(F.col("id").alias("product_id"), "title", "slug", *_priced(), *_stamps())


def stg_product_categories(products: DataFrame) -> DataFrame:
    pairs = products.select(F.col("id").alias("product_id"), F.explode(string_list(F.col("categories"))).alias("c"))
    return pairs.select(
        "product_id", ref_id(F.col("c")).alias("category_id"),
        F.get_json_object("c", "$.title").alias("category_name"),
        F.get_json_object("c", "$.slug").alias("category_slug"),
    )


def stg_variants(variants: DataFrame, accept_bare: bool = False) -> DataFrame:
    return variants.select(
        F.col("id").alias("variant_id"), F.col("title").alias("variant_title"),
        ref_id(F.col("product"), accept_bare, strict=True).alias("product_id"), *_priced(), *_stamps(),
    )


def stg_categories(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.col("id").alias("category_id"), F.col("title").alias("category_name"),
        F.col("slug").alias("category_slug"), *_stamps(),
    )


def stg_customers(users: DataFrame) -> DataFrame:
    """Users that hold the customer role, whatever other roles they hold."""
    customers = users.filter(F.array_contains(string_list(F.col("roles")), "customer"))
    return customers.select(F.col("id").alias("customer_id"), "name", "email", *_stamps())
