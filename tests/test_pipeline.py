"""From landed pages to reports, twice: a first load and a later one with changes."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from storelake.operators import quality
from storelake.plans import affinity, customers, products, sales
from storelake.plans.models import MARTS, Lake
from storelake.sources.load import load, raw_tables
from storelake.sources.pages import read_collections
from storelake.sources.schemas import COLLECTIONS

AS_OF = dt.date(2024, 4, 1)


def times(created, updated=None):
    return {"createdAt": f"{created}T10:00:00.000Z", "updatedAt": f"{updated or created}T10:00:00.000Z"}


def order(i, customer, lines, cents, created, status="completed", updated=None):
    items = [{"id": f"{i}-{n}", "product": {"id": p, "title": "t"}, "variant": v and {"id": v}, "quantity": q}
             for n, (p, v, q) in enumerate(lines)]
    return {"id": i, "customer": {"id": customer, "name": "x"}, "customerEmail": "e", "items": items, "amount": cents,
            "currency": "USD", "status": status, **times(created, updated)}


def payment(o, status="succeeded"):
    return {"id": o["id"] * 10, "order": {"id": o["id"]}, "customer": o["customer"], "amount": o["amount"],
            "currency": "USD", "paymentMethod": "card", "status": status, "createdAt": o["createdAt"], "updatedAt": o["updatedAt"]}


CATALOG = {
    "products": [{"id": i, "title": t, "slug": t, "priceInUSD": c, "inventory": n, "enableVariants": i == 2, "_status": "published",
                  "categories": [{"id": 1, "title": "Tools", "slug": "tools"}], **times("2024-01-01")}
                 for i, t, c, n in ((1, "bolt", 150, 5), (2, "saw", 2000, 0), (3, "nut", 50, 100))],
    "variants": [{"id": 21, "title": "big saw", "product": {"id": 2}, "priceInUSD": 2500, "inventory": 3, "options": [{"id": 1}],
                  **times("2024-01-01")}],
    "categories": [{"id": 1, "title": "Tools", "slug": "tools", **times("2024-01-01")}],
    "users": [{"id": i, "name": f"n{i}", "email": f"n{i}@x", "roles": ["customer"], **times("2024-01-01")} for i in (1, 2, 3)],
    "carts": [{"id": 1, "customer": None, "items": [], "currency": "USD", "subtotal": 5, "purchasedAt": None, **times("2024-01-01")}],
    "variantTypes": [{"id": 1, "label": "Size", "name": "size", **times("2024-01-01")}],
    "variantOptions": [{"id": 1, "variantType": {"id": 1}, "label": "Big", "value": "big", **times("2024-01-01")}],
}


def land(folder, name, docs, page):
    (folder / name).mkdir(parents=True, exist_ok=True)
    body = {"docs": docs, "totalDocs": len(docs), "page": page, "hasNextPage": False}
    (folder / name / f"{page}.json").write_text(json.dumps(body))


def run(spark, folder, store):
    load(read_collections(spark, str(folder)), store)
    lake = Lake(raw_tables(store), store, AS_OF)
    lake.run_models()
    return lake


def months(lake):
    rows = sales.monthly_revenue(lake.table("fact_orders"), lake.table("dim_date")).collect()
    return {r["year_month"]: (r["total_orders"], r["total_revenue_usd"]) for r in rows}


def test_two_loads(spark, store, tmp_path):
    first = [order(1, 1, [(1, None, 2), (2, 21, 1)], 2800, "2024-01-05"), order(2, 2, [(1, None, 1), (2, None, 1)], 2150, "2024-01-20"),
             order(3, 1, [(1, None, 1), (2, 21, 1), (1, None, 1)], 2800, "2024-02-10")]
    for name, docs in {**CATALOG, "orders": first, "transactions": [payment(o) for o in first]}.items():
        land(tmp_path, name, docs, 1)
    assert set(CATALOG) | {"orders", "transactions"} == set(COLLECTIONS)
    lake = run(spark, tmp_path, store)
    assert lake.whole_documents
    assert months(lake) == {"2024-01": (2, Decimal("49.50")), "2024-02": (1, Decimal("28.00"))}

    report = quality.run_tests({**raw_tables(store), **{m: lake.table(m) for m in MARTS}})
    assert tuple(quality.totals(report).first()) == (40, 0, 40)

    pairs = affinity.product_affinity(*[lake.table(t) for t in ("fact_order_items", "fact_orders", "dim_products")])
    assert [tuple(r) for r in pairs.collect()] == [("bolt", "saw", 3, Decimal("100.00"))]
    top = products.top_selling_units(lake.table("fact_order_items"), lake.table("dim_products")).collect()
    assert [tuple(r) for r in top] == [("saw", 3, Decimal("70.00")), ("bolt", 5, Decimal("7.50"))]

    # One order changes, one is new; orders of other months keep their stored files.
    before = set(store.manifest("dev_marts/fact_orders")["dirs"])
    later = [order(3, 1, [(3, None, 4)], 200, "2024-02-10", "refunded", "2024-03-02"), order(4, 3, [], 999, "2024-03-01")]
    land(tmp_path, "orders", later, 2)
    lake = run(spark, tmp_path, store)
    assert months(lake) == {"2024-01": (2, Decimal("49.50")), "2024-02": (1, Decimal("2.00")), "2024-03": (1, Decimal("9.99"))}
    kept = before & set(store.manifest("dev_marts/fact_orders")["dirs"])
    assert [d.split("=")[-1] for d in kept] == ["2024-01-01"]
    dims = {r["customer_id"]: (r["total_orders"], r["customer_segment"]) for r in lake.table("dim_customers").collect()}
    assert dims == {1: (2, "Potential Loyalists"), 2: (1, "New Customers"), 3: (1, "New Customers")}
    idle = {r["customer_id"]: r["days_since_last_order"] for r in customers.customer_ltv_model(
        lake.table("dim_customers"), lake.table("fact_orders"), AS_OF).collect()}
    assert idle == {1: 87, 2: 72, 3: 31}
    # Lines that left the order stay in the line fact, as a keyed merge leaves them.
    lines = lake.table("fact_order_items").filter("order_id = 3")
    assert lines.count() == 3 and lines.filter("product_id = 3").count() == 1
