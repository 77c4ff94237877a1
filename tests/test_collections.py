"""Document filters, access rules, data tests and the behaviour of joins under skew."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storelake.operators import collections as docs
from storelake.operators import quality
from storelake.operators.joins import left_join_optional
from storelake.operators.numbering import numbered


@pytest.fixture
def products(spark):
    return spark.createDataFrame([
        (1, "Blue Ring 50%", "published", 10, ["a", "b"]), (2, "ring of blue", "draft", None, ["b"]),
        (3, "bolt_x", None, 30, None), (4, None, "published", 40, []),
    ], "id long, title string, _status string, price long, tags array<string>")


@pytest.mark.parametrize("spec,want", [
    ({}, [1, 2, 3, 4]),
    ({"title": {"like": "blue ring"}}, [1, 2]), ({"title": {"contains": "blue ring"}}, [1]),
    ({"title": {"contains": "50%"}}, [1]), ({"title": {"like": "t_x"}}, [3]),
    ({"_status": {"equals": "draft"}}, [2]), ({"_status": {"equals": None}}, [3]),
    ({"_status": {"not_equals": "draft"}}, [1, 3, 4]),
    ({"price": {"greater_than": 10, "less_than": 40}}, [3]), ({"price": {"greater_than_equal": 10, "less_than_equal": 30}}, [1, 3]),
    ({"price": {"exists": False}}, [2]), ({"price": {"exists": True}}, [1, 3, 4]),
    ({"price": {"in": [10, 40]}}, [1, 4]), ({"price": {"not_in": [10, 40]}}, [2, 3]),
    ({"_status": {"in": "draft, published"}}, [1, 2, 4]),
    ({"tags": {"contains": "b"}}, [1, 2]), ({"tags": {"all": ["a", "b"]}}, [1]), ({"tags": {"in": ["a", "z"]}}, [1]),
    ({"or": [{"id": {"equals": 3}}, {"and": [{"price": {"equals": 10}}, {"_status": {"equals": "published"}}]}]}, [1, 3]),
])
def test_where(products, spec, want):
    assert sorted(r["id"] for r in docs.where(products, spec).collect()) == want


def test_where_on_references(spark):
    rows = spark.createDataFrame([(1, '{"id":5}', '[{"id":3},4]'), (2, "5", "[3]"), (3, '{"id":6}', None), (4, None, "[]")],
                                 "id long, customer string, categories string")
    def ids(spec):
        return sorted(r["id"] for r in docs.where(rows, spec, ["customer"], ["categories"]).collect())
    assert ids({"customer": {"equals": 5}}) == [1, 2] and ids({"customer": {"not_in": [5]}}) == [3, 4]
    assert ids({"customer": {"exists": False}}) == [4] and ids({"categories": {"contains": 3}}) == [1, 2]
    assert ids({"categories": {"all": [3, 4]}}) == [1] and ids({"categories": {"in": [4, 9]}}) == [1]
    assert ids({"categories": {"not_in": [4]}}) == [2, 3, 4]


def test_where_reaches_the_scan(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(10).withColumn("v", F.col("id") * 2).write.parquet(path)
    found = docs.select(docs.where(spark.read.parquet(path), {"v": {"greater_than": 4}}), "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(v,4)" in plan


def test_where_refuses_unknown_operators(products):
    with pytest.raises(ValueError):
        docs.where(products, {"id": {"near": 1}})


def test_sort_and_page(products):
    assert [r["id"] for r in docs.sort(products, "-price").collect()] == [4, 3, 1, 2]
    pages = [[r["id"] for r in docs.page(products, 3, n, "id").collect()] for n in (1, 2, 3)]
    assert pages == [[1, 2, 3], [4], []]
    assert [r["id"] for r in docs.page(products, 0, by="-id", tie_break=None).collect()] == [4, 3, 2, 1]
    assert docs.select(products, "title, price").columns == ["id", "title", "price"]


def test_all_pages_equal_a_walk_and_a_plain_numbering(spark):
    rows = spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, id % 5) as price", "1 as position", "'x' as page")
    rows = rows.drop("position", "page").repartition(7, "price")
    for by in ("price", "-price"):
        found = docs.pages(rows, 30, by)
        got = [(r["page"], r["position"], r["id"]) for r in found.collect()]
        walked = [(n, i, r["id"]) for n in range(1, 35) for i, r in enumerate(docs.page(rows, 30, n, by).collect(), 1)]
        assert sorted(got) == walked
    assert docs.pages(rows.filter("id < 0"), 30, "id").collect() == []
    assert {r["page"] for r in docs.pages(rows, 0, "id").collect()} == {1}


def test_numbering_within_groups_keeps_nulls_apart_and_no_task_gathers_all(spark):
    rows = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 'hot', if(id % 3 = 1, null, cast(id % 50 as string))) as g",
                                        "id % 11 as v")
    found = numbered(rows, [F.col("v").desc(), F.col("id")], "n", ["g"])
    plain = rows.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc(), "id")).cast("bigint"))
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    plan = numbered(rows, [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1 and "HashAggregate(keys=[_part" in plan.split("SinglePartition")[1][:400]


def test_access_rules(spark):
    rows = spark.createDataFrame([(1, '{"id":5}', "published"), (2, '{"id":6}', "draft"), (3, "5", "draft")],
                                 "id long, customer string, _status string")
    def seen(rule, user=None):
        return sorted(r["id"] for r in docs.visible_rows(rows, rule, user).collect())
    admin, customer = {"id": 9, "roles": ["admin"]}, {"id": 5, "roles": ["customer"]}
    assert all(seen(rule, admin) == [1, 2, 3] for rule in ("admin", "owner", "self", "published", "public"))
    assert [seen(r, customer) for r in ("admin", "owner", "self", "published", "public")] == [[], [1, 3], [], [1], [1, 2, 3]]
    assert [seen(r) for r in ("admin", "owner", "self", "published", "public")] == [[], [], [], [1], [1, 2, 3]]
    with pytest.raises(ValueError):
        docs.visible_rows(rows, "other")


def test_product_search(spark):
    rows = spark.createDataFrame([
        (1, "Ring", "gold", "published", '[{"id":3}]'), (2, "Bolt", "for a ring", "published", "[3, 4]"),
        (3, "Ring", "tin", "draft", "[3]"), (4, "Nut", None, "published", None),
    ], "id long, title string, description string, _status string, categories string").selectExpr(
        "*", "concat('s', id) as slug", "id * 100 as priceInUSD")
    ids = lambda **args: [r["id"] for r in docs.product_search(rows, **args).collect()]
    admin = {"id": 1, "roles": ["admin"]}
    assert ids() == [2, 4, 1] and ids(user=admin) == [2, 4, 1, 3]
    assert ids(text="RING") == [2, 1] == ids(text="ring", user=admin)
    assert ids(category=4) == [2] and ids(text="gold", category=4) == [] and ids(text="gold", category=3) == [1]
    assert ids(by="Price: High to low") == [4, 2, 1]


def test_order_lookup_needs_an_owner(spark):
    rows = spark.createDataFrame([(1, '{"id":5}', "e@x")], "id long, customer string, customerEmail string")
    count = lambda **who: docs.order_lookup(rows, 1, **who).count()
    assert [count(), count(customer=5), count(customer=6), count(email="e@x"), count(email="no"),
            count(customer=5, email="no")] == [0, 1, 0, 1, 0, 0]


def test_populate(spark):
    orders = spark.createDataFrame([(1, '{"id":5}'), (2, "5"), (3, None), (4, '{"id":99}')], "id long, customer string")
    users = spark.createDataFrame([(5, "Ann")], "id long, name string")
    got = {r["id"]: r["customer"] and tuple(r["customer"]) for r in docs.populate(orders, {"customer": users}).collect()}
    assert got == {1: (5, "Ann"), 2: (5, "Ann"), 3: None, 4: None}


def test_populate_lists_and_depth(spark):
    orders = spark.createDataFrame([(1, "[3, null, {\"id\":4}, 99, 3]", '{"id":5}'), (2, "[]", "6"), (3, None, None)],
                                   "id long, tags string, owner string")
    tags = spark.createDataFrame([(3, "x", "7"), (4, "y", None)], "id long, label string, kind string")
    kinds = spark.createDataFrame([(7, "k", "[1]")], "id long, name string, orders string")
    users = spark.createDataFrame([(5, "[2, 1]")], "id long, orders string")
    r = docs.Relation
    relations = {"orders": {"tags": r("tags", many=True), "owner": r("users")}, "tags": {"kind": r("kinds")},
                 "kinds": {"orders": r("orders", many=True)}, "users": {"orders": r("orders", many=True)}}
    every = {"orders": orders, "tags": tags, "kinds": kinds, "users": users}
    def found(depth):
        return {row["id"]: row.asDict(recursive=True) for row in docs.populate_depth("orders", every, relations, depth).collect()}
    assert found(0)[1]["tags"].startswith("[3")
    one, three = found(1), found(3)
    assert [t and (t["label"], t["kind"]) for t in one[1]["tags"]] == [("x", "7"), None, ("y", None), None, ("x", "7")]
    assert one[2]["tags"] == [] and one[3]["tags"] is None and one[2]["owner"] is None
    assert three[1]["tags"][0]["kind"] == {"id": 7, "name": "k", "orders": "[1]"}  # Orders stand above: the cycle ends.
    assert three[1]["owner"] == {"id": 5, "orders": "[2, 1]"} and three[1]["tags"][2]["kind"] is None


def test_run_tests_scans_each_table_once(spark, tmp_path):
    spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, "zz", 50), (None, None, 7)], "k long, s string, v int").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    suite = [quality.Check("t", "unique", "k"), quality.Check("t", "unique", "s"), quality.Check("t", "not_null", "k"),
             quality.Check("t", "not_null", "v"), quality.Check("t", "accepted_values", "s", {"values": ["a"]}),
             quality.Check("t", "accepted_range", "v", {"low": 6, "high": 40}), quality.Check("t", "not_null", "s")]
    report = quality.run_tests({"t": table}, suite)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [r["failures"] for r in report.collect()] == [1, 0, 1, 1, 2, 2, 1]
    assert [r["failures"] for r in quality.run_tests({"t": table.limit(0)}, suite).collect()] == [0] * 7
    raw = {name: spark.read.parquet(f"{tmp_path}/t") for name in dict.fromkeys(c.table for c in quality.configured_suite())}
    whole = {n: df.selectExpr(*[f"k as `{c}`" for c in dict.fromkeys(x.column for x in quality.configured_suite() if x.table == n)])
             for n, df in raw.items()}
    assert quality.run_tests(whole)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 14 == len(raw)


def test_unique_texts_are_told_by_hash(spark, monkeypatch):
    """A text column without equal hashes gives the scan no rows to group; with some the texts decide."""
    told = []
    plain = quality._one_scan
    monkeypatch.setattr(quality, "_one_scan", lambda df, checks, passed=(): told.append(set(passed)) or plain(df, checks, passed))
    suite = [quality.Check("t", "unique", "s"), quality.Check("t", "unique", "k")]
    failures = lambda rows: [r["failures"] for r in quality.run_tests(
        {"t": spark.createDataFrame(rows, "s string, k long")}, suite).collect()]
    assert failures([("a", 1), ("b", 1), (None, 2), (None, 3)]) == [0, 1] and told[-1] == {"unique_t_s"}
    assert failures([("a", 1), ("a", 2), ("b", 3), ("b", 4), ("b", 5)]) == [2, 0] and told[-1] == set()
    monkeypatch.setattr(quality.F, "xxhash64", lambda *_: F.lit(7).cast("bigint"))
    assert failures([("a", 1), ("b", 1)]) == [0, 1] and told[-1] == set()


def catalog(spark):
    products = spark.createDataFrame([(1, 100, 5, True), (2, 200, 0, False), (3, 300, 9, False), (4, None, 1, True), (5, 50, 3, True)],
                                     "id long, priceInUSD long, inventory long, enableVariants boolean")
    variants = spark.createDataFrame([(11, '{"id":1}', 80, 0, "[1,{\"id\":2}]"), (12, "1", 150, None, "[3]"), (41, '{"id":4}', 70, 2, None),
                                      (21, '{"id":2}', 999, 7, "[]")],
                                     "id long, product string, priceInUSD long, inventory long, options string")
    return products, variants


def test_prices_offers_and_stock(spark):
    products, variants = catalog(spark)
    ranges = {r[0]: (r[1], r[2]) for r in docs.product_price_range(products, variants).collect()}
    assert ranges == {1: (80, 150), 2: (200, 200), 3: (300, 300), 4: (70, 70), 5: (50, 50)}
    offers = {r[0]: (r[1], r[2]) for r in docs.product_offer(products, variants).collect()}
    assert offers == {1: (False, 150), 2: (False, 200), 3: (True, 300), 4: (True, None), 5: (False, 50)}
    stock = {(r[0], r[1]): r["notice"] for r in docs.stock_status(products, variants).collect()}
    assert stock == {(1, 11): "Out of stock", (1, 12): "Out of stock", (4, 41): "Only 2 left in stock",
                     (2, None): "Out of stock", (3, None): "Only 9 left in stock"}


def test_match_variant(spark):
    _, variants = catalog(spark)
    found = {r["variant_id"]: r["is_available"] for r in docs.match_variant(variants, [1, 2]).collect()}
    assert found == {11: False, 21: True}


def test_carts(spark):
    products, variants = catalog(spark)
    carts = spark.createDataFrame([
        (1, '[{"product":{"id":1},"variant":{"id":11},"quantity":1},{"product":2,"quantity":0}]'),
        (2, '[{"product":3,"quantity":8},{"product":1,"quantity":2}]'), (3, "[]"), (4, None),
        (5, '[{"product":{"id":4},"variant":41,"quantity":1}]'), (6, '[{"product":3}]'),
    ], "id long, items string")
    assert {r[0]: r[1] for r in docs.cart_quantity(carts).collect()} == {1: 1, 2: 10, 3: None, 4: None, 5: 1, 6: 0}
    over = sorted((r["cart_id"], r["product_id"]) for r in docs.cart_over_stock(carts, products, variants).collect())
    assert over == [(1, 1), (1, 2), (2, 1)]


def test_quality_operators(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None)], "id long, v string")
    assert [tuple(r) for r in quality.test_unique(df, "id").collect()] == [(1, 2)]
    assert quality.test_not_null(df, "id").count() == 2
    assert sorted(tuple(r) for r in quality.test_accepted_values(df, "v", ["a"]).collect()) == [("b", 1), ("c", 1)]
    parents = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [r[0] for r in quality.test_relationships(df, "v", parents, "k").collect()] == ["c"]
    assert quality.test_accepted_range(df, "id", 1, None).count() == 0
    assert quality.test_accepted_range(df, "id", 1, None, inclusive=False).count() == 2
    assert quality.test_singular(df.filter("v = 'c'")).count() == 1


def test_configured_suite_reports_failures(spark):
    suite = quality.configured_suite()
    assert len(suite) == 40 and len({c.name for c in suite}) == 40
    df = spark.createDataFrame([(1, "x"), (1, None)], "id long, status string")
    checks = [quality.Check("t", "unique", "id"), quality.Check("t", "not_null", "status"), quality.Check("t", "not_null", "id"),
              quality.Check("t", "accepted_values", "status", {"values": ["y"]})]
    report = quality.run_tests({"t": df}, checks)
    assert {r["test"]: (r["failures"], r["status"]) for r in report.collect()} == {
        "unique_t_id": (1, "ERROR"), "not_null_t_status": (1, "ERROR"), "not_null_t_id": (0, "PASS"),
        "accepted_values_t_status": (1, "ERROR")}
    assert tuple(quality.totals(report).first()) == (1, 3, 4)


def test_null_references_spread_over_partitions(spark):
    left = spark.range(8000).select(F.col("id").alias("row"), F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("k"))
    right = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = left_join_optional(left, right, "k", "row")
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert joined.filter("k is not null and v = k * 10").count() == 800
        assert joined.count() == 8000 == sum(sizes) and max(sizes) < 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_hot_key_of_a_join_is_split(spark):
    """A third of the lines belong to one order: adaptive execution splits its partition."""
    from storelake.operators.marts import fact_order_items
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB"}
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        order = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
        items = spark.range(0, n, 1, 16).select(
            F.col("id").cast("string").alias("order_item_id"), order.alias("order_id"), (F.col("id") % 50).alias("product_id"),
            F.lit(None).cast("bigint").alias("variant_id"), F.lit(1).alias("quantity"))
        now = F.lit(dt.datetime(2024, 1, 1))
        orders = spark.range(0, n, 1, 16).select(F.col("id").alias("order_id"), now.alias("created_at"), now.alias("updated_at"))
        price = F.lit(1).cast("decimal(18,2)").alias("price_usd")
        products = spark.range(50).select(F.col("id").alias("product_id"), price)
        variants = spark.range(50).select(F.col("id").alias("variant_id"), price)
        facts = fact_order_items(items, orders, variants, products)
        assert len(facts.collect()) == n
        assert "isSkew=true" in facts._jdf.queryExecution().executedPlan().toString().replace("skew=true", "isSkew=true")
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_lists_equal_any_of_their_elements_and_relations_contain_ids(spark):
    df = spark.createDataFrame([(1, '[{"id":5},{"id":6}]', '{"id":1}'), (2, "[7]", '{"id":12}'), (3, None, None), (4, "[]", "1")],
                               "id long, tags string, owner string")
    def ids(spec):
        return sorted(r["id"] for r in docs.where(df, spec, relations=["owner"], lists=["tags"]).collect())
    assert ids({"tags": {"equals": 6}}) == [1]
    assert ids({"tags": {"not_equals": 6}}) == [2, 3, 4]
    assert ids({"tags": {"equals": None}}) == [3]
    assert ids({"owner": {"contains": 1}}) == [1, 4] == ids({"owner": {"contains": "1"}})
    assert ids({"owner": {"contains": "x"}}) == []


@pytest.mark.parametrize("by", ["createdAt", "-createdAt,title", "title"])
def test_a_walk_by_last_key_sees_every_row_once(spark, by):
    rows = [(i, [None, "a", "b"][i % 3], [None, 5, 3, 5][i % 4]) for i in range(25)]
    df = spark.createDataFrame(rows, "id long, title string, createdAt long")
    want = [r["id"] for r in docs.sort(df, by).collect()]
    names = [n.lstrip("-") for n in by.split(",")] + ["id"]
    seen, last = [], None
    while found := docs.page(df, 4, by=by, after=last).collect():
        seen += [r["id"] for r in found]
        last = [found[-1][n] for n in names]
    assert seen == want
