"""Steps that hold or move less than whole rows: right on odd input, and really taken."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import types as T

from storelake.functions.dates import moment
from storelake.operators import marts
from storelake.operators.joins import left_join_found
from storelake.plans import affinity, products
from storelake.plans.models import Lake
from storelake.sources import inspect
from storelake.workspace import AS_OF, SPINE, workspace


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_meet_the_sizes_of_their_orders_once(spark, monkeypatch):
    monkeypatch.setattr(affinity, "GIANT", 3)
    lines = spark.createDataFrame([(1, p) for p in range(5)] + [(2, 1), (2, 2), (3, 1)], "order_id long, product_id long")
    sizes = spark.createDataFrame([(1, 5), (2, 2)], "order_id long, item_count long")
    got = sorted((r["order_id"], r["product_id"], r["item_count"]) for r in affinity._with_size(lines, sizes).collect())
    assert got == [(1, p, 5) for p in range(5)] + [(2, 1, 2), (2, 2, 2), (3, 1, None)]


def test_pairs_are_formed_in_the_tasks_asked_for(spark):
    lines = spark.createDataFrame([(o, p) for o in range(4) for p in (1, 2)], "order_id long, product_id long")
    found = affinity._paired(lines, 7)
    assert [tuple(r) for r in found.collect()] == [(1, 2, 4)] and "RepartitionByExpression" in plan(found)


def test_orders_of_categories_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(products, "LINES_PER_TASK", 2)
    items = spark.createDataFrame([(1, 1, 2, 1.0), (1, 2, 3, 2.0), (2, 1, None, None), (None, 1, 1, 4.0), (3, 9, 1, 1.0)],
                                  "order_id long, product_id long, quantity int, line_total_usd double").withColumn(
        "line_total_usd", products.F.col("line_total_usd").cast("decimal(18,2)"))
    bridge = spark.createDataFrame([(1, 7), (2, 7), (2, 8)], "product_id long, category_id long")
    categories = spark.createDataFrame([(7, "a"), (8, "b")], "category_id long, category_name string")
    found = products.category_performance(items, bridge, categories)
    got = [(r[0], r[1], r[2], float(r[3]), float(r[4])) for r in found.collect()]
    assert got == [("a", 2, 6, 7.0, 2.33), ("b", 1, 3, 2.0, 2.0)] and "RepartitionByExpression" in plan(found)


def test_sample_is_sought_by_the_first_column(spark):
    kind = "k long, v string"
    for rows in ([(3, "c"), (1, "b"), (1, "a"), (2, "z"), (1, "d")], [(None, "n"), (5, "x"), (None, "m"), (4, "y")],
                 [(None, str(i)) for i in range(5)], [(1, "a")], []):
        df = spark.createDataFrame(rows, kind)
        report = inspect.table_summary({"t": df})
        want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[:3]
        found = report.first()
        assert found["records"] == len(rows)
        assert sorted((x.get("k"), x["v"]) for x in map(json.loads, found["sample"] or []) if x.get("k") is not None) == sorted(
            r for r in want if r[0] is not None)
        assert len(found["sample"] or []) == len(want)
    assert plan(report).count("Sort [") > 1


def test_summary_of_many_tables_does_not_wait_for_itself(spark):
    tables = {f"t{i}": spark.createDataFrame([(j, "x") for j in range(i)], "k long, v string") for i in range(20)}
    report = inspect.table_summary(tables)
    # A subquery inside another waits for a thread; with 16 outer ones there is none, and the query never ends.
    subqueries = report._jdf.queryExecution().optimizedPlan().subqueriesAll()
    assert all(subqueries.apply(i).subqueriesAll().isEmpty() for i in range(subqueries.size()))
    assert [tuple(r) for r in report.collect()] == [
        (f"t{i}", 2, i, [f'{{"k":{j},"v":"x"}}' for j in range(min(i, 3))]) for i in range(20)]


def test_changed_fragments_are_found_by_written_ids(spark):
    w = workspace(spark, "/root/testdata/sf0.001")
    lake = Lake(w.raw, w.fresh_store(), AS_OF, SPINE)
    mark = dt.datetime(2001, 6, 1)
    changed = lake.changed_since(mark.isoformat(sep=" "), ("orders",)).raw["order_fragments"]
    late = w.raw["orders"].filter(w.raw["orders"]["updatedAt"] >= moment(mark, T.TimestampNTZType())).select("id")
    assert changed.count() == w.raw["order_fragments"].join(late, "id", "left_semi").count() > 0
    assert any("/sorted/" in f for f in changed.inputFiles())


def test_large_price_lists_are_sought_once_for_each_pair_of_references(spark, tmp_path):
    lines = [("a", 1, 1, 11, 2), ("b", 1, 1, None, 3), ("c", 2, None, 11, 1), ("d", 2, None, None, 4), ("e", 2, 9, 99, 5),
             ("f", 3, 2, 21, None), ("g", 3, 2, 12, 1), ("g", 3, 2, 12, 1), (None, 1, 1, 11, 7), ("h", 8, 1, 11, 1), ("i", None, 1, 11, 1)]
    items = spark.createDataFrame(lines, "order_item_id string, order_id long, product_id long, variant_id long, quantity int")
    now = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame([(i, now, now) for i in (1, 2, 3)], "order_id long, created_at timestamp_ntz, updated_at timestamp_ntz")

    def stored(name, rows):
        df = spark.createDataFrame(rows, f"{name} long, price_usd double")
        df.withColumn("price_usd", products.F.col("price_usd").cast("decimal(18,2)")).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    # A variant without a price, ids that occur twice, and one that is NULL.
    variants = stored("variant_id", [(11, 1.5), (12, 3.0), (12, 4.0), (21, None), (None, 8.0)])
    known = stored("product_id", [(1, 1.0), (2, 2.0), (2, 2.5), (None, 9.0)])
    saved, got = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), {}
    try:
        for limit in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            facts = marts.fact_order_items(items, orders, variants, known)
            got[limit] = sorted(map(tuple, facts.collect()), key=repr)
            untimed = marts.fact_order_items(items.join(orders, "order_id"), None, variants, known)
            assert sorted(map(tuple, untimed.collect()), key=repr) == got[limit]
            assert ("Aggregate [product_id" in plan(facts)) == (limit == "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    few, many = got.values()
    assert few == many
    prices = sorted((r[0] or "", float(r[5])) for r in many)
    assert prices == [("", 1.5), ("a", 1.5), ("b", 1.0), ("c", 1.5), ("d", 0.0), ("e", 0.0), ("f", 2.0), ("f", 2.5)] + [
        ("g", p) for p in (3.0, 3.0, 3.0, 3.0, 4.0, 4.0, 4.0, 4.0)]


def test_lines_without_references_are_spread(spark):
    n, settings = 8000, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    left = spark.range(n).selectExpr("id row", "if(id % 10 = 0, id % 7, null) a", "if(id % 20 = 0, 1L, null) b")
    found = left.select("a", "b").distinct().selectExpr("a", "b", "coalesce(a, 0) + coalesce(b, 100) v")
    saved = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = left_join_found(left, found, ["a", "b"], "row")
        rows = joined.select("row", "a", "b", "v").collect()
        sizes = [r[0] for r in joined.groupBy(products.F.spark_partition_id()).count().select("count").collect()]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert len(rows) == len({r["row"] for r in rows}) == n == sum(sizes) and max(sizes) < n / 2
    assert all(r["v"] == (None if r["a"] is None else r["a"] + (r["b"] or 100)) for r in rows)


def test_stored_tables_are_written_in_a_dense_codec(spark, store):
    rows = spark.range(10).selectExpr("id", "id % 2 part", "timestamp_ntz'2024-01-01' updatedAt")
    for name, parts in (("plain", []), ("parted", ["part"])):
        store.replace(rows, name, parts, ["id"])
        store.merge(rows.filter("id < 3"), name, ["id"])
        files = store.read(name).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files) and store.read(name).count() == 10
