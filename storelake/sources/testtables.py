"""Shapes the order/part/customer/event test tables into the nine raw collections.

Every rule is a projection of one table: no join, no grouping, no global numbering. In particular an
order's lines are never gathered into one document, since nothing bounds how many lines an order
has. Each line becomes an *order fragment*, a document with the order's id and a one-element
``items`` list. Unnesting the fragments gives the rows that unnesting whole documents gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CREATED = "1994-12-31 00:00:00"
_STATUS = {"F": "completed", "O": "processing", "P": "cancelled"}
_PAYMENT = {"F": "succeeded", "O": "pending", "P": "failed"}


def _cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def _ref(key: Column) -> Column:
    return F.to_json(F.struct(key.alias("id")))


def _mapped(code: str, names: dict[str, str]) -> Column:
    result = F.lit(None).cast("string")
    for key, name in names.items():
        result = F.when(F.col(code) == key, name).otherwise(result)
    return result


def _name_id(name: Column) -> Column:
    """A category id that needs no numbering pass: the leading 28 bits of the name's hash."""
    return F.conv(F.substring(F.md5(name), 1, 7), 16, 10).cast("bigint")


def _slug(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "[^A-Za-z0-9]+", "-"))


def _category(name: Column) -> Column:
    return F.struct(_name_id(name).alias("id"), name.alias("title"), _slug(name).alias("slug"))


def _stamps(created: Column) -> list[Column]:
    stamp = created.cast("timestamp_ntz")
    return [stamp.alias("createdAt"), stamp.alias("updatedAt")]


def _orders(orders: DataFrame) -> DataFrame:
    email = F.format_string("Customer#%09d@example.test", F.col("o_custkey"))
    return orders.select(
        F.col("o_orderkey").alias("id"), _ref(F.col("o_custkey")).alias("customer"),
        email.alias("customerEmail"), _cents("o_totalprice").alias("amount"),
        F.lit("USD").alias("currency"), _mapped("o_orderstatus", _STATUS).alias("status"),
        *_stamps(F.col("o_orderdate")),
    )


def _order_fragments(lineitem: DataFrame) -> DataFrame:
    item_id = F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("bigint"), _cents("l_extendedprice"),
    )
    odd = F.col("l_linenumber") % 2 == 1
    item = F.struct(
        item_id.alias("id"), F.struct(F.col("l_partkey").alias("id")).alias("product"),
        F.when(odd, F.struct((F.col("l_partkey") * 10 + 1).alias("id"))).alias("variant"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    used = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return lineitem.select(*used).select(F.col("l_orderkey").alias("id"), F.to_json(F.array(item)).alias("items"))


def whole_orders(orders: DataFrame) -> DataFrame:
    """Order documents that hold all their lines: none, an empty list, or one to four made by rule from the order's key.

    The third line's references are bare numbers. Every set of tables has the 200 parts they name.
    """
    key = F.col("id")

    def line(j: Column) -> Column:
        part = 1 + (key * 31 + j * 17) % 200
        refer = lambda number: F.when(j == 3, number.cast("string")).otherwise(F.format_string('{"id":%d}', number))
        variant = F.when(j % 2 == 1, refer(part * 10 + 1)).otherwise("null")
        return F.format_string('{"id":"%d-%d","product":%s,"quantity":%d,"variant":%s}', key, j, refer(part), (key + j) % 7 + 1, variant)

    lines = F.transform(F.sequence(F.lit(1).cast("bigint"), key % 6 - 1), line)
    items = F.when(key % 6 == 0, F.lit(None)).when(key % 6 == 1, F.lit("[]")).otherwise(
        F.concat(F.lit("["), F.array_join(lines, ","), F.lit("]")))
    return orders.withColumn("items", items)


def _transactions(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"), _ref(F.col("o_orderkey")).alias("order"),
        _ref(F.col("o_custkey")).alias("customer"), _cents("o_totalprice").alias("amount"),
        F.lit("USD").alias("currency"), F.lit("stripe").alias("paymentMethod"),
        _mapped("o_orderstatus", _PAYMENT).alias("status"), *_stamps(F.col("o_orderdate")),
    )


def _carts(events: DataFrame) -> DataFrame:
    product = F.get_json_object("props", "$.k").cast("bigint")
    item = F.struct(
        F.struct(product.alias("id")).alias("product"),
        F.when(F.col("event_id") % 2 == 1, F.struct((product * 10 + 1).alias("id"))).alias("variant"),
        (F.col("event_id") % 25 + 1).alias("quantity"),
    )
    ts = F.col("ts").cast("timestamp_ntz")
    return events.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_id") % 3 != 0, _ref(F.col("user_id"))).alias("customer"),
        F.to_json(F.array(item)).alias("items"), F.lit("USD").alias("currency"),
        _cents("value").alias("subtotal"),
        F.when(F.col("event_type") == "purchase", ts).alias("purchasedAt"), *_stamps(ts),
    )


def _products(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    both = F.array(_category(F.col("p_type")), _category(F.col("p_brand")))
    return part.select(
        key.alias("id"), F.col("p_name").alias("title"),
        F.concat_ws("-", _slug(F.col("p_name")), key).alias("slug"),
        F.concat_ws(" ", F.col("p_type"), F.col("p_brand")).alias("description"),
        _cents("p_retailprice").alias("priceInUSD"),
        F.pmod(key * 7, F.lit(60)).alias("inventory"),
        (F.col("p_size") > 25).alias("enableVariants"),
        F.when(key % 17 != 0, F.to_json(both)).alias("categories"),
        F.when(key % 11 == 0, "draft").otherwise("published").alias("_status"), *_stamps(F.lit(_CREATED)),
    )


def _option_ids() -> Column:
    return F.array(F.lit(1000) + F.col("p_size"), F.lit(2000) + F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int"))


def _variants(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    price = F.call_function("div", _cents("p_retailprice") * 11 + 5, F.lit(10))
    return part.filter(F.col("p_size") > 25).select(
        (key * 10 + 1).alias("id"), F.concat(F.col("p_name"), F.lit(" large")).alias("title"),
        _ref(key).alias("product"), price.alias("priceInUSD"),
        F.pmod(key * 3, F.lit(40)).alias("inventory"), F.to_json(_option_ids()).alias("options"),
        *_stamps(F.lit(_CREATED)),
    )


def _categories(part: DataFrame) -> DataFrame:
    names = part.select(F.col("p_type").alias("name")).unionAll(part.select("p_brand")).distinct()
    return names.select(_category(F.col("name")).alias("c"), *_stamps(F.lit(_CREATED))).select(
        "c.id", "c.title", "c.slug", "createdAt", "updatedAt")


def _users(customer: DataFrame) -> DataFrame:
    admin = F.col("c_custkey") % 50 == 0
    return customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.concat(F.col("c_name"), F.lit("@example.test")).alias("email"),
        F.when(admin, '["admin"]').otherwise('["customer"]').alias("roles"), *_stamps(F.lit(_CREATED)),
    )


def _variant_options(part: DataFrame) -> DataFrame:
    sizes = part.select(F.lit(1).alias("type"), (F.lit(1000) + F.col("p_size")).alias("id"),
                        F.col("p_size").cast("string").alias("value")).distinct()
    brands = part.select(F.lit(2), F.element_at(_option_ids(), 2), F.col("p_brand")).distinct()
    both = sizes.unionAll(brands)
    return both.select(
        F.col("id").cast("bigint").alias("id"), _ref(F.col("type")).alias("variantType"),
        F.col("value").alias("label"), _slug(F.col("value")).alias("value"), *_stamps(F.lit(_CREATED)))


def _variant_types(part: DataFrame) -> DataFrame:
    named = F.explode(F.array(
        F.struct(F.lit(1).cast("bigint").alias("id"), F.lit("Size").alias("label"), F.lit("size").alias("name")),
        F.struct(F.lit(2).cast("bigint").alias("id"), F.lit("Brand").alias("label"), F.lit("brand").alias("name"))))
    return part.select(named.alias("t")).distinct().select("t.*", *_stamps(F.lit(_CREATED)))


def raw_collections(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine collections plus ``order_fragments``, all lazy."""
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    orders, part = table("orders"), table("part")
    return {
        "orders": _orders(orders),
        "order_fragments": _order_fragments(table("lineitem")),
        "transactions": _transactions(orders),
        "carts": _carts(table("events")),
        "products": _products(part),
        "variants": _variants(part),
        "categories": _categories(part),
        "users": _users(table("customer")),
        "variantTypes": _variant_types(part),
        "variantOptions": _variant_options(part),
    }
