"""Document corner cases and the mart rules that depend on them."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from storelake.operators import marts, staging
from storelake.plans.models import Lake

T = dt.datetime(2024, 1, 31)


def orders(spark, rows):
    return spark.createDataFrame(
        [(*r, T, T) for r in rows],
        "id long, customer string, items string, amount long, currency string, status string,"
        " createdAt timestamp, updatedAt timestamp")


def users(spark, rows):
    return spark.createDataFrame([(i, f"n{i}", f"n{i}@x", roles, T, T) for i, roles in rows],
                                 "id long, name string, email string, roles string, createdAt timestamp, updatedAt timestamp")


def products(spark, rows):
    return spark.createDataFrame([(i, f"p{i}", f"p-{i}", price, stock, cats, T, T) for i, price, stock, cats in rows],
                                 "id long, title string, slug string, priceInUSD long, inventory long, categories string,"
                                 " createdAt timestamp, updatedAt timestamp")


def variants(spark, rows):
    return spark.createDataFrame([(i, f"v{i}", p, price, 1, T, T) for i, p, price in rows],
                                 "id long, title string, product string, priceInUSD long, inventory long,"
                                 " createdAt timestamp, updatedAt timestamp")


ITEMS = ('[{"id":"a","product":{"id":1,"title":"x, \\"y\\"","tags":[1,{"id":9}]},"variant":{"id":11},"quantity":2},'
         '{"id":"b","product":{"id":2},"variant":null,"quantity":3},{"id":"c","product":5,"quantity":1}]')


def test_items_unnest(spark):
    raw = orders(spark, [(1, '{"id":7}', ITEMS, 100, "USD", "completed"), (2, "8", "[]", 1, "USD", "x"),
                         (3, None, None, 1, "USD", "x"), (4, "null", "not json", 1, "USD", "x")])
    got = sorted(tuple(r) for r in staging.stg_order_items(raw).collect())
    assert got == [("a", 1, 1, 11, 2), ("b", 1, 2, None, 3), ("c", 1, None, None, 1)]
    bare = {r["order_item_id"]: r["product_id"] for r in staging.stg_order_items(raw, accept_bare=True).collect()}
    assert bare == {"a": 1, "b": 2, "c": 5}


def test_bare_relation_is_null_unless_accepted(spark):
    raw = orders(spark, [(1, '{"id":7,"orders":[{"id":1}]}', None, 1, "USD", "x"), (2, "8", None, 1, "USD", "x"),
                         (3, None, None, 1, "USD", "x")])
    strict = {r[0]: r[1] for r in staging.stg_orders(raw).collect()}
    assert strict == {1: 7, 2: None, 3: None}
    assert {r[0]: r[1] for r in staging.stg_orders(raw, accept_bare=True).collect()} == {1: 7, 2: 8, 3: None}


@pytest.mark.parametrize("items, customer", [('[{"id":"a","product":{"id":"x1"},"quantity":1}]', None), ('[{"id":"a","quantity":"many"}]', None),
                                             (None, '{"id":"seven"}')])
def test_damaged_ids_are_errors(spark, items, customer):
    raw = orders(spark, [(1, customer, items, 1, "USD", "x")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_order_items(raw).collect() if items else staging.stg_orders(raw).collect()


def test_customers_keep_the_role_among_others(spark):
    raw = users(spark, [(1, '["customer"]'), (2, '["admin"]'), (3, '["admin","customer"]'), (4, None), (5, "[]")])
    assert sorted(r[0] for r in staging.stg_customers(raw).collect()) == [1, 3]


def test_product_categories(spark):
    raw = products(spark, [(1, 1999, 5, '[{"id":3,"title":"A","slug":"a"},{"id":"x","title":"B"}]'), (2, None, 0, None), (3, 5, None, "[]")])
    rows = sorted(staging.stg_product_categories(raw).collect(), key=lambda r: r["category_name"])
    assert [tuple(r) for r in rows] == [(1, 3, "A", "a"), (1, None, "B", None)]
    assert marts.bridge_product_categories(staging.stg_product_categories(raw)).count() == 1
    prices = {r["product_id"]: r["price_usd"] for r in staging.stg_products(raw).collect()}
    assert prices == {1: Decimal("19.99"), 2: None, 3: Decimal("0.05")}


def test_stock_flags_at_the_limit(spark):
    raw = products(spark, [(i, 1, stock, None) for i, stock in enumerate([None, 0, 1, 10, 11])])
    rows = marts.dim_products(staging.stg_products(raw)).orderBy("product_id").collect()
    assert [(r["is_in_stock"], r["is_low_stock"]) for r in rows] == [
        (False, False), (False, False), (True, True), (True, True), (True, False)]


def whole_lake(spark, store):
    raw = {
        "orders": orders(spark, [(1, '{"id":7}', ITEMS, 12345, "USD", "completed"), (2, '{"id":7}', None, 1, "USD", "x")]),
        "products": products(spark, [(1, 100, 1, None), (2, None, 1, None)]),
        "variants": variants(spark, [(11, '{"id":1}', 250), (12, '{"id":2}', None)]),
        "users": users(spark, [(7, '["customer"]'), (8, '["customer"]')]),
    }
    return raw, Lake(raw, store, dt.date(2024, 3, 1))


def test_whole_documents_and_fragments_give_the_same_facts(spark, store):
    raw, lake = whole_lake(spark, store)
    parts = Lake({**raw, "order_fragments": raw["orders"].select("id", "items")}, store, lake.as_of)
    assert lake.whole_documents and not parts.whole_documents
    from storelake.plans.models import MARTS
    for name in ("fact_orders", "fact_order_items"):
        whole, split = MARTS[name].build(lake), MARTS[name].build(parts)
        assert whole.columns == split.columns
        assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, split.collect()), key=repr)
    counts = {r["order_id"]: (r["amount_usd"], r["item_count"]) for r in MARTS["fact_orders"].build(lake).collect()}
    assert counts == {1: (Decimal("123.45"), 3), 2: (Decimal("0.01"), 0)}
    lines = {r["order_item_id"]: (r["unit_price_usd"], r["line_total_usd"])
             for r in MARTS["fact_order_items"].build(lake).collect()}
    assert lines == {"a": (Decimal("2.50"), Decimal("5.00")), "b": (Decimal("0.00"), Decimal("0.00")),
                     "c": (Decimal("0.00"), Decimal("0.00"))}


def test_customer_without_orders(spark, store):
    _, lake = whole_lake(spark, store)
    rows = {r["customer_id"]: r for r in lake.table("dim_customers").collect()}
    assert rows[8]["total_orders"] == 0 and rows[8]["lifetime_value_usd"] == 0 and rows[8]["customer_segment"] == "Dormant"
    assert rows[8]["customer_since"] == T and rows[8]["customer_lifetime_days"] == 30
    assert rows[7]["total_orders"] == 2 and rows[7]["customer_segment"] == "Potential Loyalists"


def test_segment_limits(spark):
    rows = spark.createDataFrame([(n,) for n in (0, 1, 2, 4, 5, 9, 10)], "n long")
    got = [r[0] for r in rows.select(marts.customer_segment(rows["n"])).collect()]
    assert got == ["Dormant", "New Customers", "Potential Loyalists", "Potential Loyalists", "Loyal", "Loyal", "Champions"]


def test_default_date_spine(spark):
    days = marts.dim_date(marts.date_bounds(spark))
    assert days.count() == 4018
    first = days.orderBy("date_key").first()
    assert (first["date_key"], first["day_name"], first["day_of_week"], first["week_of_year"]) == (dt.date(2020, 1, 1), "Wednesday", 3, 1)
    assert days.filter("is_weekend != (day_of_week in (6, 7)) or is_holiday_season != (month in (11, 12))").count() == 0
