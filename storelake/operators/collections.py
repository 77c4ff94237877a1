"""Document-collection queries: filter, sort, page, project, populate and the shop's read rules."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.documents import id_list, ref_id, string_list
from storelake.functions.predicates import Fields, where_column
from storelake.operators.joins import left_join_optional
from storelake.operators.numbering import numbered

# The shop's named orderings and its stock notice limit.
SORTS = {
    "Alphabetic A-Z": "title", "Latest arrivals": "-createdAt",
    "Price: Low to high": "priceInUSD", "Price: High to low": "-priceInUSD",
}
STOCK_NOTICE = 10


def where(df: DataFrame, spec: Mapping[str, Any], relations: Collection[str] = (),
          lists: Collection[str] = ()) -> DataFrame:
    """Rows that meet a filter document; ``relations`` and ``lists`` name JSON reference columns."""
    return df.filter(where_column(Fields(df, relations, lists), spec))


def sort_columns(spec: str, tie_break: str | None = "id") -> list[Column]:
    """``"-createdAt,title"`` or a named ordering. The key last keeps equal values spread and stable."""
    columns = []
    for part in SORTS.get(spec, spec).split(","):
        name = part.strip()
        columns.append(F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last())
    return columns + ([F.col(tie_break)] if tie_break else [])


def sort(df: DataFrame, spec: str, tie_break: str | None = "id") -> DataFrame:
    return df.orderBy(*sort_columns(spec, tie_break))


def _after(spec: str, tie_break: str, last: Sequence[Any]) -> Column:
    """Rows that come after one with these sort values, missing values last."""
    names = [part.strip() for part in SORTS.get(spec, spec).split(",")] + [tie_break]
    same, after = F.lit(True), F.lit(False)
    for name, value in zip(names, last, strict=True):
        col = F.col(name.lstrip("-"))
        if value is not None:
            beyond = col < F.lit(value) if name.startswith("-") else col > F.lit(value)
            after = after | (same & (beyond | col.isNull()))
        same = same & col.eqNullSafe(F.lit(value))
    return after


def page(df: DataFrame, limit: int = 10, page: int = 1, by: str = "createdAt", tie_break: str = "id",
         after: Sequence[Any] | None = None) -> DataFrame:
    """Page ``page`` of ``limit`` rows; 0 means no limit.

    Planned as a top-k of all rows up to the page's end, so it suits the first pages. To walk through a whole
    collection, give the sort values and the key of the last row seen as ``after`` and stay on page 1: each
    page is then a top-k of its own rows only.
    """
    ordered = sort(df if after is None else df.filter(_after(by, tie_break, after)), by, tie_break)
    return ordered if limit == 0 else ordered.offset((page - 1) * limit).limit(limit)


def pages(df: DataFrame, limit: int = 10, by: str = "createdAt", tie_break: str = "id") -> DataFrame:
    """All pages at once: every row with its ``page`` and its ``position`` on it, both from 1.

    Equal to walking through ``page`` from the first to the last, as one distributed pass: no task holds more
    than its range of rows. A ``limit`` of 0 makes one page.
    """
    found = numbered(df, sort_columns(by, tie_break), "position")
    if limit == 0:
        return found.withColumn("page", F.lit(1).cast("bigint"))
    before = F.col("position") - 1
    return found.withColumns({"page": F.floor(before / limit) + 1, "position": before % limit + 1})


def select(df: DataFrame, fields: str | Sequence[str], key: str = "id") -> DataFrame:
    """Projection; the key always comes along."""
    names = fields.split(",") if isinstance(fields, str) else list(fields)
    return df.select(*dict.fromkeys([key, *[n.strip() for n in names]]))


def populate(df: DataFrame, references: Mapping[str, DataFrame], accept_bare: bool = True) -> DataFrame:
    """Replace each reference column by the referenced row, NULL when it does not resolve."""
    for name, target in references.items():
        order = df.columns
        found = target.select(F.col("id").alias("_ref"), F.struct(*target.columns).alias("_row"))
        keyed = df.withColumn("_ref", ref_id(F.col(name), accept_bare))
        row_key = "id" if "id" in order else order[0]
        joined = left_join_optional(keyed, found, "_ref", row_key).drop(name, "_ref")
        df = joined.withColumnRenamed("_row", name).select(*order)
    return df


@dataclass(frozen=True)
class Relation:
    """A field that refers to documents of another collection, by one id or by a list of them."""
    target: str
    many: bool = False


def _populated_list(df: DataFrame, name: str, target: DataFrame, accept_bare: bool) -> DataFrame:
    """A list of references as the list of referenced rows, in its order; an element that does not resolve is NULL in its place.

    Elements are joined one by one, so that a much referenced document is an ordinary skewed join, and regrouped.
    """
    order = df.columns
    lists = string_list(F.col(name))
    rows = df.select(F.col("id").alias("_id"), F.struct(*[c for c in order if c != name]).alias("_doc"),
                     lists.isNull().alias("_none"), F.posexplode_outer(lists).alias("_at", "_element"))
    keyed = rows.withColumn("_ref", ref_id(F.col("_element"), accept_bare))
    found = target.select(F.col("id").alias("_ref"), F.struct(*target.columns).alias("_row"))
    joined = left_join_optional(keyed, found, "_ref", "_id")
    element = F.when(F.col("_at").isNotNull(), F.struct("_at", "_row"))
    grouped = joined.groupBy("_id").agg(
        F.first("_doc").alias("_doc"), F.first("_none").alias("_none"), F.sort_array(F.collect_list(element)).alias("_list"))
    populated = F.when(~F.col("_none"), F.transform("_list", lambda e: e["_row"])).alias(name)
    return grouped.select("_doc.*", populated).select(*order)


def populate_depth(collection: str, collections: Mapping[str, DataFrame], relations: Mapping[str, Mapping[str, Relation]],
                   depth: int = 1, accept_bare: bool = True, _above: tuple[str, ...] = ()) -> DataFrame:
    """A collection with its references replaced by documents, theirs too down to ``depth`` levels.

    Single references and lists; NULL lists stay NULL, empty ones empty. A reference to a collection that
    stands above it on the way down stays a reference, so that cycles end. Documents are told apart by ``id``.
    """
    df = collections[collection]
    if depth < 1:
        return df
    for name, relation in relations.get(collection, {}).items():
        above = (*_above, collection)
        if relation.target in above:
            continue
        target = populate_depth(relation.target, collections, relations, depth - 1, accept_bare, above)
        if relation.many:
            df = _populated_list(df, name, target, accept_bare)
        else:
            df = populate(df, {name: target}, accept_bare)
    return df


def product_search(products: DataFrame, text: str | None = None, category: int | None = None, by: str = "title",
                   user: Mapping[str, Any] | None = None) -> DataFrame:
    """Products whose title or description holds the words, within a category.

    Only published ones, except that an admin who asks for neither words nor a category sees all.
    """
    found = visible_rows(products, "published", user)
    if text or category is not None:
        found = where(found, {"_status": {"equals": "published"}})
    if text:
        found = where(found, {"or": [{"title": {"like": text}}, {"description": {"like": text}}]})
    if category is not None:
        found = where(found, {"categories": {"contains": category}}, lists=["categories"])
    return sort(found, by).select("id", "title", "slug", "categories", "priceInUSD")


def products_in_categories(products: DataFrame, ids: Sequence[int] = (), limit: int | None = None) -> DataFrame:
    found = where(products, {"categories": {"in": ids}}, lists=["categories"]) if ids else products
    return page(found, limit) if limit else found


def _owned(rows: DataFrame, customer: int) -> DataFrame:
    return where(rows, {"customer": {"equals": customer}}, relations=["customer"])


def customer_orders(orders: DataFrame, customer: int, limit: int = 0) -> DataFrame:
    return page(_owned(orders, customer), limit, by="-createdAt")


def order_lookup(orders: DataFrame, order: int, customer: int | None = None, email: str | None = None) -> DataFrame:
    """One order, for its owner or for a guest who knows the email. Neither given: nothing."""
    if customer is None and not email:
        return orders.limit(0)
    found = orders.filter(F.col("id") == order)
    if customer is not None:
        found = _owned(found, customer)
    return found.filter(F.col("customerEmail") == email) if email else found


def visible_rows(df: DataFrame, rule: str, user: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows a user may read under a rule: admin, owner, self, published or public."""
    if rule not in ("admin", "owner", "self", "published", "public"):
        raise ValueError(f"unknown access rule: {rule}")
    admin = bool(user) and "admin" in (user.get("roles") or ())
    if admin or rule == "public":
        return df
    if rule == "published":
        return df.filter(F.col("_status") == "published")
    if rule == "admin" or not user or user.get("id") is None:
        return df.limit(0)
    if rule == "owner":
        return _owned(df, user["id"])
    return df.filter(F.col("id") == user["id"])


def _by_product(variants: DataFrame) -> DataFrame:
    return variants.withColumn("product_id", ref_id(F.col("product"), True)).groupBy("product_id").agg(
        F.min("priceInUSD").alias("v_low"), F.max("priceInUSD").alias("v_high"),
        F.coalesce(F.bool_or(F.col("inventory") > 0), F.lit(False)).alias("v_stock"),
    )


def _with_variants(products: DataFrame, variants: DataFrame) -> DataFrame:
    return products.withColumnRenamed("id", "product_id").join(_by_product(variants), "product_id", "left")


def product_price_range(products: DataFrame, variants: DataFrame) -> DataFrame:
    """Lowest and highest price in cents: over the variants when enabled, else the own price."""
    own, enabled = F.col("priceInUSD"), F.coalesce("enableVariants", F.lit(False))
    ranged = enabled & F.col("v_low").isNotNull()
    return _with_variants(products, variants).select(
        "product_id", F.when(ranged, F.col("v_low")).otherwise(own).alias("lowest_price"),
        F.when(ranged, F.col("v_high")).otherwise(own).alias("highest_price"),
    )


def product_offer(products: DataFrame, variants: DataFrame) -> DataFrame:
    """Stock flag, and the dearest of the variants and the product itself."""
    own, enabled = F.col("priceInUSD"), F.coalesce("enableVariants", F.lit(False))
    in_stock = F.when(enabled, F.coalesce("v_stock", F.lit(False))).otherwise(F.coalesce("inventory", F.lit(0)) > 0)
    # A product without a price keeps none: its variants are only compared against a price.
    dearest = F.when(enabled & (F.coalesce(own, F.lit(0)) != 0), F.greatest(own, "v_high")).otherwise(own)
    return _with_variants(products, variants).select(
        "product_id", in_stock.alias("in_stock"), dearest.alias("offer_price"))


def stock_status(products: DataFrame, variants: DataFrame, limit: int = STOCK_NOTICE) -> DataFrame:
    """Stock notice per sellable unit: each variant of a product with variants, else the product."""
    chosen = variants.select(
        ref_id(F.col("product"), True).alias("product_id"), F.col("id").alias("variant_id"),
        F.coalesce("inventory", F.lit(0)).alias("v_quantity"))
    base = products.select(
        F.col("id").alias("product_id"), F.coalesce("enableVariants", F.lit(False)).alias("enabled"),
        F.coalesce("inventory", F.lit(0)).alias("p_quantity"))
    single = base.filter(~F.col("enabled")).select(
        "product_id", F.lit(None).cast("bigint").alias("variant_id"), F.col("p_quantity").alias("quantity"))
    several = base.filter("enabled").join(chosen, "product_id").select(
        "product_id", "variant_id", F.col("v_quantity").alias("quantity"))
    quantity = F.col("quantity")
    notice = F.when(quantity == 0, "Out of stock").when(
        (quantity > 0) & (quantity < limit), F.format_string("Only %d left in stock", quantity))
    return single.unionByName(several).withColumn("notice", notice)


def match_variant(variants: DataFrame, selected: Sequence[int]) -> DataFrame:
    """Variants all of whose options are among the selected ones, with availability."""
    chosen = F.array(*[F.lit(int(o)).cast("bigint") for o in selected])
    options = id_list(F.col("options"))
    fits = options.isNotNull() & F.forall(options, lambda o: F.array_contains(chosen, o))
    return variants.filter(fits).select(
        F.col("id").alias("variant_id"), ref_id(F.col("product"), True).alias("product_id"),
        (F.coalesce("inventory", F.lit(0)) > 0).alias("is_available"))


_CART_ITEM = "array<struct<product string, variant string, quantity bigint>>"


def cart_quantity(carts: DataFrame) -> DataFrame:
    """Units per cart; NULL for a cart without lines."""
    items = F.from_json("items", _CART_ITEM)
    total = F.aggregate(items, F.lit(0).cast("bigint"), lambda acc, i: acc + F.coalesce(i["quantity"], F.lit(0)))
    return carts.select(F.col("id").alias("cart_id"), F.when(F.size(items) > 0, total).alias("quantity"))


def cart_over_stock(carts: DataFrame, products: DataFrame, variants: DataFrame) -> DataFrame:
    """Cart lines that already ask for all the stock there is, or more."""
    lines = carts.select(F.col("id").alias("cart_id"), F.explode(F.from_json("items", _CART_ITEM)).alias("i")).select(
        "cart_id", ref_id(F.col("i.product"), True).alias("product_id"),
        ref_id(F.col("i.variant"), True).alias("variant_id"), F.col("i.quantity").alias("quantity"))
    stock = products.select(
        F.col("id").alias("product_id"), F.coalesce("enableVariants", F.lit(False)).alias("enabled"), "inventory")
    held = variants.select(
        ref_id(F.col("product"), True).alias("product_id"), F.col("id").alias("variant_id"),
        F.col("inventory").alias("v_inventory"))
    joined = lines.join(stock, "product_id").join(held, ["product_id", "variant_id"], "left")
    available = F.coalesce(F.when(F.col("enabled"), F.col("v_inventory")).otherwise(F.col("inventory")), F.lit(0))
    return joined.select("cart_id", "product_id", "variant_id", "quantity", available.alias("available")).filter(
        "quantity >= available")
