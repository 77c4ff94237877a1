"""Every operator as a named query over the test tables, with the parameters the tests use."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.functions.dates import moment
from storelake.functions.documents import ref_id
from storelake.operators import collections as docs
from storelake.operators import marts, quality, staging
from storelake.plans import (
    affinity, cohorts, customers, distribution, kpi, payments, products, rfm, sales,
)
from storelake.plans.models import MARTS, STAGING, Lake
from storelake.sources import inspect, pages, types
from storelake.sources.load import load, load_landed, raw_tables
from storelake.sources.schemas import COLLECTIONS, collection_schema
from storelake.streaming.upsert import read_page_stream, stream_upsert
from storelake.workspace import AS_OF, SPINE, Workspace, land, name_id, workspace

CUTOFF = dt.datetime(2001, 6, 1)
SEASON = (dt.datetime(2000, 11, 1), dt.datetime(2000, 12, 31))
COHORTS = ("2000-10", "2000-11", "2000-12", "1995-01", "1995-02")
GAP_CATEGORY = name_id("Brand#1")
SEARCH_CATEGORY = name_id("PROMO")
SELECTED_OPTIONS = [1000 + size for size in range(26, 41)] + [2000 + brand for brand in range(1, 13)]
CUSTOMER, ORDER = 7, 965

Query = Callable[[Workspace], DataFrame]


# --- sources and sinks ------------------------------------------------------------------------


def _older_newer(w: Workspace) -> tuple[DataFrame, DataFrame]:
    orders = w.raw["orders"]
    late = F.col("updatedAt") >= moment(CUTOFF, T.TimestampNTZType())
    return orders.filter(~late), orders.filter(late)


def _changed(rows: DataFrame) -> DataFrame:
    """Two later versions of each row, in one batch: the newest must win."""
    def version(n: int) -> DataFrame:
        return rows.withColumns({"amount": F.col("amount") + n, "updatedAt": F.col("updatedAt") + F.expr(f"interval {n} hours")})
    return version(2).unionAll(version(1))


def _partitioned(rows: DataFrame) -> DataFrame:
    return rows.withColumn("month", F.trunc(F.to_date("createdAt"), "month"))


def _write_append(w: Workspace) -> DataFrame:
    store, (older, newer) = w.fresh_store(), _older_newer(w)
    store.append(older, "orders")
    store.append(newer, "orders")
    return store.read("orders")


def _write_replace(w: Workspace) -> DataFrame:
    store, (older, newer) = w.fresh_store(), _older_newer(w)
    store.replace(older, "orders")
    store.replace(newer, "orders")
    return store.read("orders")


def _merged(w: Workspace):
    store, (older, newer) = w.fresh_store(), _older_newer(w)
    store.replace(_partitioned(older.unionAll(newer)), "orders", ["month"])
    store.merge(_partitioned(_changed(newer)), "orders", ["id"])
    return store


def _write_skip(w: Workspace) -> DataFrame:
    store, (older, newer) = w.fresh_store(), _older_newer(w)
    store.skip(older, "orders")
    store.skip(newer, "orders")
    return store.read("orders")


def _create_if_missing(w: Workspace) -> DataFrame:
    store = w.fresh_store()
    store.append(w.raw["orders"], "orders")
    return store.read("orders")


def _incremental_load(w: Workspace) -> DataFrame:
    """Two loads: the older orders, then everything from the saved cursor on, with changed amounts."""
    store, (older, newer) = w.fresh_store(), _older_newer(w)
    load({"orders": older}, store, initial=dt.datetime(1995, 1, 1))
    load({"orders": older.unionAll(_changed(newer))}, store)
    return raw_tables(store)["orders"]


def _landed_load(w: Workspace) -> DataFrame:
    """Page files of changed new orders land first, those of all orders later: only new files are read, the newest rows stay."""
    store, orders = w.fresh_store(), w.whole_orders
    root, late = f"{store.root}/landing", F.col("updatedAt") >= moment(CUTOFF, T.TimestampNTZType())
    for part in (_changed(orders.filter(late)), orders):
        land(part, f"{root}/orders", nested=("customer", "items"))
        load_landed(store, root, ["orders"], zoned=False)
    return raw_tables(store)["orders"]


def _more_fields(w: Workspace) -> DataFrame:
    """Users with fields that no schema declares; some documents lack them."""
    known = w.source("customer").select(
        F.col("c_custkey").alias("id"), F.round(F.col("c_acctbal") * 100).cast("bigint").alias("points"),
        F.struct(F.col("c_nationkey").alias("country"), F.col("c_mktsegment").alias("label")).alias("homeAddress"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 2 == 0).alias("newsletter"))
    return w.raw["users"].join(known, "id")


def _inferred_fields(w: Workspace) -> DataFrame:
    """A table made of landed pages takes its columns from them; later pages add a field."""
    store = w.fresh_store()
    root, users = f"{store.root}/landing", _more_fields(w)
    land(users.filter("id % 2 = 1"), f"{root}/users")
    load_landed(store, root, ["users"], zoned=False)
    land(users.filter("id % 2 = 0").withColumn("rating", F.col("id") / 4), f"{root}/users")
    load_landed(store, root, ["users"], zoned=False)
    return raw_tables(store)["users"].select("id", "points", "homeAddress", "newsletter", "rating")


def _read_collection_pages(w: Workspace) -> DataFrame:
    folder = w.landed("users") + "/users"
    return pages.read_collection_pages(w.spark, folder, collection_schema("users", zoned=False), landing=w.landing, collection="users")


def _read_collections(w: Workspace) -> DataFrame:
    names = tuple(COLLECTIONS)
    sets = pages.read_collections(w.spark, w.landed(*names), names, zoned=False, landing=w.landing)
    return inspect.layer_counts(sets).withColumnRenamed("layer", "collection")


def _debug_sample(w: Workspace) -> DataFrame:
    sample = pages.debug_sample(w.raw)
    return sample["orders"].select(F.lit("orders").alias("collection"), "id", "createdAt").unionAll(
        sample["products"].select(F.lit("products"), "id", "createdAt"))


def _align(w: Workspace) -> DataFrame:
    stored = T.StructType.fromDDL("id bigint, status string, amount double, discount double")
    return types.align_to_schema(w.raw["orders"], stored)


def _map_types(w: Workspace) -> DataFrame:
    lines = w.source("lineitem")
    return types.map_types(lines.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("float").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        (F.col("l_returnflag") == "R").alias("returned"), F.to_date("l_shipdate").alias("shipped"),
        F.struct(F.col("l_partkey").alias("id")).alias("product"),
        F.array("l_suppkey", F.col("l_linenumber").cast("bigint")).alias("pair")))


def _stored_marts(w: Workspace) -> dict[str, DataFrame]:
    return {name: w.lake.table(name) for name in MARTS}


def _layer_counts(w: Workspace) -> DataFrame:
    return inspect.layer_counts({
        "raw": w.raw["orders"], "staging": w.lake.staged("stg_orders"), "marts": w.lake.table("fact_orders")})


def _freshness(w: Workspace) -> DataFrame:
    return inspect.freshness({
        "raw_created": (w.raw["orders"], "createdAt"), "raw_updated": (w.raw["orders"], "updatedAt"),
        "marts": (w.lake.table("fact_orders"), "order_date")})


def _duplicate_loads(w: Workspace) -> DataFrame:
    """Facts built from raw orders that were appended twice: each order must count once."""
    store = w.fresh_store()
    for _ in range(2):
        store.append(w.raw["orders"], "raw/orders")
    lake = Lake({**w.raw, "orders": store.read("raw/orders")}, store, AS_OF, SPINE)
    lake.run_models("fact_orders")
    return lake.table("fact_orders").groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount_usd").alias("amount_usd"), F.sum("item_count").alias("items"))


def _run_models(w: Workspace) -> DataFrame:
    """Rows of every fact and of the product and customer dimensions after one build in an empty store."""
    store = w.fresh_store()
    lake = Lake(w.raw, store, AS_OF, SPINE)
    lake.run_models("marts")
    names = ("fact_orders", "fact_order_items", "fact_transactions", "dim_customers", "dim_products")
    return inspect.layer_counts({name: lake.table(name) for name in names})


def _list_tables(w: Workspace) -> DataFrame:
    """The stored marts by name, with their rows."""
    w.lake.table("fact_orders"), w.lake.table("fact_transactions")
    store = w.fresh_store()
    for name in ("fact_orders", "fact_transactions"):
        store.replace(w.lake.table(name), f"marts/{name}")
    return inspect.layer_counts({name.split("/")[1]: store.read(name) for name in store.list_tables("marts")})


def _schema_change(w: Workspace) -> DataFrame:
    """A later batch with a new column: the stored table widens, older rows have none."""
    store, (older, newer) = w.fresh_store(), _older_newer(w)
    store.replace(older, "orders")
    store.merge(newer.withColumn("channel", F.lit("web")), "orders", on_schema_change="sync")
    return store.read("orders").select("id", "channel")


def _schema_removed(w: Workspace) -> DataFrame:
    """A later batch without some columns: the table loses them."""
    store, (older, newer) = w.fresh_store(), _older_newer(w)
    store.replace(older, "orders")
    store.append(newer.drop("customerEmail", "currency", "createdAt"), "orders", on_schema_change="sync_all")
    return store.read("orders").select("*", ref_id(F.col("customer")).alias("customer_id")).drop("customer", "updatedAt")


def _schema_widened(w: Workspace) -> DataFrame:
    """A later batch with fractions in a column of whole numbers, and a new column: the table follows."""
    store, (older, newer) = w.fresh_store(), _older_newer(w)
    store.replace(older, "orders", keys=["id"], buckets=8)
    store.merge(newer.withColumns({"amount": F.col("amount") / 4, "channel": F.lit("web")}), "orders", on_schema_change="sync_all")
    return store.read("orders").select("id", "amount", "channel")


def _schema_incompatible(w: Workspace) -> DataFrame:
    """A later batch with lists in a column of texts is refused; shown with the rows that stay."""
    store, (older, newer) = w.fresh_store(), _older_newer(w)
    store.replace(older.withColumn("status", F.array("status")), "lists")
    store.replace(older, "orders")
    odd = types.schema_difference(store.schema("lists"), store.schema("orders")).incompatible
    try:
        store.append(newer, "lists", on_schema_change="sync_all")
    except types.SchemaChanged:
        named = [F.struct(F.lit(n).alias("column_name"), F.lit(new.simpleString()).alias("stored"), F.lit(old.simpleString()).alias("incoming"))
                 for n, (old, new) in odd.items()]
        kept = store.read("lists").agg(F.count(F.lit(1)).alias("records"))
        return kept.select(F.explode(F.array(*named)).alias("c"), "records").select("c.*", "records")
    raise AssertionError("an incompatible column was accepted")


def _table_summary(w: Workspace) -> DataFrame:
    """Fields, records and the first keys of every raw and mart table."""
    tables = {**{f"raw.{name}": w.raw[name] for name in COLLECTIONS}, **_stored_marts(w)}
    keys = F.create_map(*[F.lit(x) for name, df in tables.items() for x in (name, df.columns[0])])
    summary = inspect.table_summary(tables)
    first = F.transform("sample", lambda row: F.from_json(row, "map<string,string>")[keys[F.col("table_name")]])
    return summary.select("table_name", "fields", "records", F.array_join(F.array_sort(first), ",").alias("first_keys"))


def _stream_upsert(w: Workspace) -> DataFrame:
    store, folder = w.fresh_store(), w.landed("carts")
    documents = read_page_stream(w.spark, f"{folder}/carts", collection_schema("carts", zoned=False))
    stream_upsert(documents, store, "carts", f"{store.root}/checkpoint", buckets=8).awaitTermination()
    return store.read("carts")


# --- models -----------------------------------------------------------------------------------


def _mart(name: str) -> Query:
    return lambda w: MARTS[name].build(w.lake)


def _dim_date(w: Workspace) -> DataFrame:
    return marts.dim_date(marts.covering_years(w.source("orders"), "o_orderdate"))


def _incremental_build(name: str) -> Query:
    """Build from the documents known at a cutoff, then again incrementally from all of them."""
    def run(w: Workspace) -> DataFrame:
        store = w.fresh_store()
        early = dict(w.raw)
        early["orders"] = w.raw["orders"].filter(F.col("updatedAt") < moment(CUTOFF, T.TimestampNTZType()))
        Lake(early, store, AS_OF, SPINE).run_models(name)
        Lake(w.raw, store, AS_OF, SPINE).run_models(name)
        return store.read(f"dev_marts/{name}").drop("order_month")
    return run


def _whole(name: str) -> Query:
    """A fact built from order documents that hold all their lines."""
    return lambda w: MARTS[name].build(w.whole_lake())


def _whole_build(w: Workspace) -> DataFrame:
    """Lines of whole documents: built from those known at a cutoff, then from the documents changed since."""
    store = w.fresh_store()
    early = w.whole_orders.filter(F.col("updatedAt") < moment(CUTOFF, T.TimestampNTZType()))
    w.whole_lake(early, store).run_models("fact_order_items")
    lake = w.whole_lake(None, store)
    lake.run_models("fact_order_items")
    return lake.table("fact_order_items").drop("order_month")


def _run_tests(w: Workspace) -> DataFrame:
    return quality.run_tests({**w.raw, **_stored_marts(w)})


# --- analytics --------------------------------------------------------------------------------


def _over(query: Callable[..., DataFrame], *tables: str, as_of: bool = False, **params) -> Query:
    """A query over stored marts or staging views, by name."""
    def run(w: Workspace) -> DataFrame:
        frames = [w.lake.table(t) if t in MARTS else w.lake.staged(t) if t in STAGING else w.raw[t] for t in tables]
        return query(*frames, *([AS_OF] if as_of else []), **params)
    return run


def _active(w: Workspace) -> DataFrame:
    return customers.active_customers(w.lake.table("fact_orders"), AS_OF)


def _category_gap(w: Workspace) -> DataFrame:
    t = w.lake.table
    return customers.category_gap(_active(w), t("fact_orders"), t("fact_order_items"),
                                  t("bridge_product_categories"), GAP_CATEGORY)


# --- collection queries -----------------------------------------------------------------------


def _where(w: Workspace) -> DataFrame:
    found = docs.where(w.raw["products"], {"or": [
        {"and": [{"title": {"like": "RING small"}}, {"inventory": {"greater_than": 10, "less_than_equal": 45}}]},
        {"and": [{"description": {"contains": "promo"}}, {"_status": {"not_equals": "draft"}},
                 {"priceInUSD": {"greater_than_equal": 95000}}, {"inventory": {"not_in": [0, 7, 14]}}]},
        {"and": [{"categories": {"all": [SEARCH_CATEGORY, GAP_CATEGORY]}}, {"inventory": {"less_than": 30}}]},
        {"and": [{"categories": {"exists": False}}, {"slug": {"exists": True}}, {"enableVariants": {"equals": True}},
                 {"inventory": {"in": [5, 10, 15, 20]}}]},
    ]}, lists=["categories"])
    return found.select("id", "title", "inventory", "_status")


def _populate(w: Workspace) -> DataFrame:
    users = docs.select(w.raw["users"], "name,email")
    found = docs.populate(w.raw["transactions"].select("id", "order", "customer"),
                          {"customer": users, "order": docs.select(w.raw["orders"], "amount,status")})
    return found.select("id", F.col("customer.name").alias("customer_name"), F.col("customer.email").alias("customer_email"),
                        F.col("order.amount").alias("order_amount"), F.col("order.status").alias("order_status"))


_RELATIONS = {
    "variants": {"product": docs.Relation("products"), "options": docs.Relation("variantOptions", many=True)},
    "products": {"categories": docs.Relation("categories", many=True)},
    "variantOptions": {"variantType": docs.Relation("variantTypes")},
}


def _populate_depth(w: Workspace) -> DataFrame:
    """Variants with their product and its categories, and their options with the types of those; one option leads nowhere."""
    lost = F.concat(F.lit("[99999,"), F.substring("options", 2, 100))
    variants = w.raw["variants"].withColumn("options", lost)
    found = docs.populate_depth("variants", {**w.raw, "variants": variants}, _RELATIONS, depth=2)
    named = lambda column: F.array_join(F.slice(column, 2, 9), ",")
    return found.select(
        "id", F.col("product.title").alias("product_title"), F.array_join("product.categories.title", ",").alias("categories"),
        named(F.col("options.label")).alias("options"), named(F.col("options.variantType.label")).alias("option_types"),
        F.element_at("options", 1)["label"].alias("lost"))


def _on_raw(query: Callable[..., DataFrame], *names: str, columns: tuple[str, ...] = (), **params) -> Query:
    def run(w: Workspace) -> DataFrame:
        found = query(*[w.raw[n] for n in names], **params)
        return found.select(*columns) if columns else found
    return run


_ITEMS = "fact_order_items"
_CATALOG = ("dim_products", "bridge_product_categories", "dim_categories")

QUERIES: dict[str, Query] = {
    # sources and sinks
    "read_collection_pages": _read_collection_pages,
    "read_collections": _read_collections,
    "incremental_extract": lambda w: pages.incremental_extract(w.raw["orders"], CUTOFF),
    "advance_cursor": lambda w: pages.advance_cursor(pages.incremental_extract(w.raw["orders"], CUTOFF)),
    "debug_sample": _debug_sample,
    "write_append": _write_append,
    "write_replace": _write_replace,
    "write_merge": lambda w: _merged(w).read("orders").drop("month"),
    "write_skip": _write_skip,
    "create_if_missing": _create_if_missing,
    "incremental_load": _incremental_load,
    "landed_load": _landed_load,
    "inferred_fields": _inferred_fields,
    "align_to_schema": _align,
    "map_types": _map_types,
    "table_summary": _table_summary,
    "layer_counts": _layer_counts,
    "list_tables": _list_tables,
    "on_schema_change": _schema_change,
    "schema_removed": _schema_removed,
    "schema_widened": _schema_widened,
    "schema_incompatible": _schema_incompatible,
    "run_models": _run_models,
    "duplicate_loads": _duplicate_loads,
    "freshness": _freshness,
    "preview": lambda w: inspect.preview(w.lake.table("fact_transactions"), 5, "transaction_id").select(
        "transaction_id", "amount_usd", "status"),
    "stream_upsert": _stream_upsert,
    # staging
    **{name: _over(lambda df: df, name) for name in STAGING},
    # marts, computed from staging
    **{name: _mart(name) for name in MARTS if name != "dim_date"},
    "dim_date": _dim_date,
    "incremental_build": _incremental_build("fact_orders"),
    "incremental_build_items": _incremental_build("fact_order_items"),
    "stg_order_items_whole": lambda w: w.whole_lake().staged("stg_order_items"),
    "stg_order_items_bare": lambda w: staging.stg_order_items(w.whole_orders, accept_bare=True),
    "fact_orders_whole": _whole("fact_orders"),
    "fact_order_items_whole": _whole("fact_order_items"),
    "incremental_build_whole": _whole_build,
    # data tests
    "test_unique": lambda w: quality.test_unique(w.source("lineitem"), "l_orderkey"),
    "test_not_null": lambda w: quality.test_not_null(w.lake.staged("stg_carts"), "customer_id").select("cart_id"),
    "test_accepted_values": lambda w: quality.test_accepted_values(w.raw["orders"], "status", ["completed", "refunded"]),
    "test_relationships": lambda w: quality.test_relationships(
        w.lake.table("fact_order_items"), "variant_id", w.lake.staged("stg_variants"), "variant_id"),
    "test_accepted_range": lambda w: quality.test_accepted_range(
        w.lake.table("fact_orders"), "amount_usd", 10000, 400000).select("order_id", "amount_usd"),
    "test_singular": lambda w: quality.test_singular(
        w.lake.table("fact_orders").filter("item_count = 0").select("order_id")),
    "run_tests": _run_tests,
    # analytics, first set
    "daily_sales_trend": _over(sales.daily_sales_trend, "fact_orders", "dim_date", as_of=True),
    "monthly_revenue": _over(sales.monthly_revenue, "fact_orders", "dim_date"),
    "weekend_vs_weekday": _over(sales.weekend_vs_weekday, "fact_orders", "dim_date", as_of=True),
    "top_products": _over(products.top_products, _ITEMS, *_CATALOG),
    "category_performance": _over(products.category_performance, _ITEMS, *_CATALOG[1:]),
    "inventory_alert": _over(products.inventory_alert, *_CATALOG),
    "potential_inventory_value": _over(products.potential_inventory_value, "dim_products"),
    "segment_overview": _over(customers.segment_overview, "dim_customers"),
    "top_customers_ltv": _over(customers.top_customers_ltv, "dim_customers"),
    "customer_acquisition": _over(customers.customer_acquisition, "dim_customers"),
    "payment_success_rate": _over(payments.payment_success_rate, "fact_transactions"),
    "daily_transactions": _over(payments.daily_transactions, "fact_transactions", "dim_date", as_of=True),
    "cohort_retention": _over(cohorts.cohort_retention, "fact_orders", as_of=True, months=72),
    "recent_cohort_curves": _over(cohorts.recent_cohort_curves, "fact_orders"),
    "cohort_curves_for": _over(cohorts.cohort_curves_for, "fact_orders", cohort_months=COHORTS),
    "rfm_table": _over(rfm.rfm_table, "dim_customers", as_of=True),
    "product_affinity": _over(affinity.product_affinity, _ITEMS, "fact_orders", "dim_products"),
    # The same list with every basket of four lines or more prefix filtered.
    "product_affinity_huge": _over(affinity.product_affinity, _ITEMS, "fact_orders", "dim_products", ordinary=3),
    "kpi_summary": _over(kpi.kpi_summary, "fact_orders", as_of=True),
    "monthly_revenue_summary_simple": _over(sales.monthly_revenue_summary_simple, "fact_orders"),
    # analytics, second set
    "cohort_pivot": _over(cohorts.cohort_pivot, "fact_orders", as_of=True, months=78),
    "cohort_by_segment": _over(cohorts.cohort_by_segment, "fact_orders", "dim_customers", as_of=True, months=79,
                               segment="Loyal"),
    "rfm_scores": _over(rfm.rfm_scores, "dim_customers", as_of=True),
    "rfm_segment_summary": _over(rfm.rfm_segment_summary, "dim_customers", as_of=True),
    "recency_distribution": _over(rfm.recency_distribution, "dim_customers", as_of=True),
    "frequency_distribution": _over(rfm.frequency_distribution, "dim_customers", as_of=True),
    "monetary_distribution": _over(rfm.monetary_distribution, "dim_customers", as_of=True),
    "active_customers": _active,
    "spend_tiers": lambda w: customers.spend_tiers(_active(w)),
    "category_gap": _category_gap,
    "lapsed_customers": _over(customers.lapsed_customers, "fact_orders", as_of=True),
    "customer_ltv_model": _over(customers.customer_ltv_model, "dim_customers", "fact_orders", as_of=True),
    "monthly_completed_revenue": _over(sales.monthly_completed_revenue, "fact_orders"),
    "top_selling_units": _over(products.top_selling_units, _ITEMS, "dim_products"),
    "repeat_customers": _over(customers.repeat_customers, "fact_orders"),
    # distribution checks
    "pareto_share": _over(distribution.pareto_share, _ITEMS),
    "cart_abandonment": _over(distribution.cart_abandonment, "stg_carts"),
    "order_count_segments": _over(customers.order_count_segments, "stg_orders"),
    "top_products_catalog_price": _over(products.top_products_catalog_price, _ITEMS, "stg_products"),
    "customer_lifetime_value": _over(customers.customer_lifetime_value, "users", "stg_orders"),
    "conversion_funnel": _over(distribution.conversion_funnel, "stg_carts"),
    "weekly_seasonality": _over(sales.weekly_seasonality, "stg_orders", start=SEASON[0], end=SEASON[1]),
    "popularity_mix": _over(distribution.popularity_mix, _ITEMS),
    # collection queries
    "where": _where,
    "sort": _on_raw(docs.sort, "products", spec="Price: High to low", columns=("id", "title", "priceInUSD")),
    "page": _on_raw(docs.page, "orders", limit=100, page=3, by="-createdAt", columns=("id", "createdAt")),
    "page_walk": _on_raw(docs.pages, "orders", limit=1000, by="-createdAt", columns=("id", "createdAt", "page", "position")),
    "select": _on_raw(docs.select, "products", fields="title,slug,priceInUSD"),
    "populate": _populate,
    "populate_depth": _populate_depth,
    "product_search": _on_raw(docs.product_search, "products", text="ring", category=SEARCH_CATEGORY,
                              columns=("id", "title", "slug", "priceInUSD")),
    "products_in_categories": _on_raw(docs.products_in_categories, "products", ids=[SEARCH_CATEGORY, GAP_CATEGORY],
                                      limit=50, columns=("id", "title")),
    "customer_orders": _on_raw(docs.customer_orders, "orders", customer=CUSTOMER, columns=("id", "amount", "status")),
    "order_lookup": _on_raw(docs.order_lookup, "orders", order=ORDER, email="Customer#000000007@example.test",
                            columns=("id", "amount", "status")),
    "visible_rows": _on_raw(docs.visible_rows, "orders", rule="owner", user={"id": CUSTOMER, "roles": ["customer"]},
                            columns=("id", "status")),
    "product_price_range": _on_raw(docs.product_price_range, "products", "variants"),
    "product_offer": _on_raw(docs.product_offer, "products", "variants"),
    "stock_status": _on_raw(docs.stock_status, "products", "variants"),
    "match_variant": _on_raw(docs.match_variant, "variants", selected=SELECTED_OPTIONS),
    "cart_quantity": _on_raw(docs.cart_quantity, "carts"),
    "cart_over_stock": _on_raw(docs.cart_over_stock, "carts", "products", "variants"),
}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare with engines that divide into doubles."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`") for f in df.schema])


def registered(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(QUERIES[name](workspace(spark, sf_dir)))
    run.__name__ = name
    return run
