"""Write modes, versions, alignment, incremental builds and the stream."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.plans.models import MARTS, Lake
from storelake.sources import inspect, pages, types
from storelake.sources import landing as landing_module
from storelake.sources.landing import Landing
from storelake.sources.load import cursors, load, load_landed, raw_tables, reset_cursors
from storelake.sources.schemas import COLLECTIONS, collection_schema
from storelake.sources import tables
from storelake.sources.tables import TableStore, repeated_keys
from storelake.streaming.upsert import read_page_stream, stream_upsert
from storelake.workspace import AS_OF, SPINE, workspace

SF = "/root/testdata/sf0.001"


def stamp(day):
    return dt.datetime(2024, 1, day)


def batch(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, updatedAt timestamp")


def rows(df):
    return sorted((tuple(r)[:2] for r in df.collect()), key=repr)


def test_append_keeps_duplicates_and_replace_does_not(spark, store):
    store.append(batch(spark, [(1, "a", stamp(1))]), "t")
    store.append(batch(spark, [(1, "b", stamp(2))]), "t")
    assert rows(store.read("t")) == [(1, "a"), (1, "b")]
    store.replace(batch(spark, [(2, "c", stamp(2))]), "t")
    assert rows(store.read("t")) == [(2, "c")]
    assert store.versions("t") == [1, 2, 3] and rows(store.read("t", 2)) == [(1, "a"), (1, "b")]


def test_merge_takes_the_newest_of_a_batch(spark, store):
    store.merge(batch(spark, [(1, "a", stamp(1)), (2, "b", stamp(1))]), "t")
    again = batch(spark, [(1, "old", stamp(2)), (1, "new", stamp(3)), (3, "c", stamp(1))])
    store.merge(again, "t")
    assert rows(store.read("t")) == [(1, "new"), (2, "b"), (3, "c")]
    store.merge(again, "t")
    assert rows(store.read("t")) == [(1, "new"), (2, "b"), (3, "c")]


def test_merge_appends_null_keys_and_batches_without_the_key(spark, store):
    store.merge(batch(spark, [(None, "a", stamp(1)), (1, "b", stamp(1))]), "t")
    store.merge(batch(spark, [(None, "c", stamp(1))]), "t")
    assert rows(store.read("t")) == [(1, "b"), (None, "a"), (None, "c")]
    store.merge(spark.createDataFrame([("z", stamp(1))], "v string, updatedAt timestamp"), "t")
    assert rows(store.read("t")) == [(1, "b"), (None, "a"), (None, "c"), (None, "z")]


def test_merge_rewrites_only_touched_partitions(spark, store):
    def parts(data):
        return spark.createDataFrame(data, "id long, v string, updatedAt timestamp, p string")
    store.replace(parts([(i, "a", stamp(1), p) for i, p in enumerate("x y y z".split())]), "t", ["p"])
    before = set(store.manifest("t")["dirs"])
    store.merge(parts([(1, "b", stamp(2), "y"), (9, "n", stamp(2), "w :%/ü=w")]), "t")
    after = set(store.manifest("t")["dirs"])
    assert {d.split("/")[-1] for d in before & after} == {"p=x", "p=z"}
    assert rows(store.read("t")) == [(0, "a"), (1, "b"), (2, "a"), (3, "a"), (9, "n")]
    # A key that moves to another partition leaves the old one, also out of one with an odd name.
    store.merge(parts([(9, "m", stamp(3), "x")]), "t")
    assert sorted((r["id"], r["p"]) for r in store.read("t").collect()) == [(0, "x"), (1, "y"), (2, "y"), (3, "z"), (9, "x")]
    assert store.read("t").filter("p = 'x'").count() == 2
    assert rows(store.read("t", 1)) == [(0, "a"), (1, "a"), (2, "a"), (3, "a")]


def test_merge_order_does_not_matter(spark, store):
    """Whatever batch comes first, the newest row per key stays, of equal times the later batch's."""
    january, february = batch(spark, [(1, "jan", stamp(1)), (2, "b", stamp(5)), (4, "t", None)]), batch(
        spark, [(1, "feb", stamp(9)), (2, "c", stamp(5)), (3, "d", stamp(2)), (4, "u", stamp(1))])
    for name, order in (("up", (january, february)), ("down", (february, january))):
        for one in order:
            store.merge(one, name)
    assert rows(store.read("up")) == [(1, "feb"), (2, "c"), (3, "d"), (4, "u")]
    assert rows(store.read("down")) == [(1, "feb"), (2, "b"), (3, "d"), (4, "u")]
    store.merge(january.filter("id = 1").drop("updatedAt"), "up")
    assert (1, "feb") in rows(store.read("up"))  # No time is older than any.


def test_bucketed_table_rewrites_one_bucket_for_one_row(spark, store):
    wide = spark.range(400).select("id", F.lit("a").alias("v"), F.lit(stamp(1)).alias("updatedAt"))
    store.merge(wide.unionAll(wide), "t", buckets=16)
    assert store.read("t").columns == ["id", "v", "updatedAt"] and store.read("t").count() == 400
    before = set(store.manifest("t")["dirs"])
    store.merge(batch(spark, [(7, "b", stamp(2)), (None, "n", stamp(2))]), "t")
    after = set(store.manifest("t")["dirs"])
    assert len(before) == 16 and len(before - after) == 1
    got = dict(rows(store.read("t")))
    assert len(got) == 401 and got[7] == "b" and got[None] == "n" and store.read("t").filter("v = 'a'").count() == 399
    store.merge(batch(spark, [(400 + i, "c", stamp(3)) for i in range(200)]), "t")
    assert store.read("t").count() == 601


def test_first_build_sorts_nothing_unless_keys_repeat(spark, store):
    plain = spark.range(50).select("id", F.lit("a").alias("v"))
    text = repeated_keys(plain, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text
    store.replace(plain, "t", keys=["id"])
    assert len(store.manifest("t")["dirs"]) == 1 and store.read("t").count() == 50
    twice = plain.unionAll(plain.withColumn("v", F.lit("b"))).unionAll(spark.range(3).selectExpr("cast(null as bigint)", "'n'"))
    store.replace(twice, "t", keys=["id"])
    assert store.read("t").filter("v = 'b'").count() == 50 and store.read("t").count() == 53


def test_empty_merge_changes_nothing(spark, store):
    store.replace(batch(spark, [(1, "a", stamp(1))]), "t")
    assert store.merge(batch(spark, []), "t") == 1 == store.versions("t")[-1]
    assert store.merge(batch(spark, []), "new") == 1 and store.read("new").count() == 0


def test_hot_partition_is_written_in_several_files(spark, store):
    """Sixteen tasks hold rows of every partition; most partitions still come out as one file."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB"}
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        month = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id") % 20))
        rows = spark.range(0, n, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), month.alias("p"))
        store.replace(rows, "t", ["p"])
        named = store.read("t").withColumn("file", F.input_file_name())
        files = named.groupBy("p").agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"))
        got = {r["p"]: (r["files"], r["n"]) for r in files.collect()}
        others = sorted(f for p, (f, _) in got.items() if p != "hot")
        assert got["hot"][0] > 1 and got["hot"][1] == n // 3 and others[len(others) // 2] == 1
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_skip_and_missing_table(spark, store):
    assert store.skip(batch(spark, [(1, "a", stamp(1))]), "t") == 1
    assert store.skip(batch(spark, [(2, "b", stamp(1))]), "t") is None
    assert rows(store.read("t")) == [(1, "a")]
    with pytest.raises(KeyError):
        store.read("none")


def test_drop_removes_only_listed_paths(spark, store, tmp_path):
    store.replace(batch(spark, [(1, "a", stamp(1))]), "raw/t")
    store.replace(batch(spark, [(1, "a", stamp(1))]), "raw/u")
    assert store.list_tables("raw") == ["raw/t", "raw/u"] == store.list_tables()
    gone = store.drop("raw/t")
    assert len(gone) == 2 and not store.exists("raw/t") and store.exists("raw/u")


def test_failed_write_leaves_the_table(spark, store):
    store.replace(batch(spark, [(1, "a", stamp(1))]), "t")
    broken = batch(spark, [(1, "x", stamp(1))]).withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception):
        store.replace(broken, "t")
    assert store.versions("t") == [1] and rows(store.read("t")) == [(1, "a")]


def test_schema_modes(spark, store):
    have = T.StructType.fromDDL("id bigint, v string, w double")
    df = spark.createDataFrame([(1, "a", True)], "id int, v string, extra boolean")
    assert types.align_to_schema(df, have).columns == ["id", "v", "w"]
    assert types.align_to_schema(df, have).first()["w"] is None
    assert types.align_to_schema(df, have, "sync").columns == ["id", "v", "w", "extra"]
    with pytest.raises(types.SchemaChanged):
        types.align_to_schema(df, have, "fail")
    store.append(spark.createDataFrame([(1, "a")], "id long, v string"), "t")
    store.append(df, "t", on_schema_change="sync")
    assert sorted(map(tuple, store.read("t").collect()), key=repr) == [(1, "a", None), (1, "a", True)]
    store.merge(spark.createDataFrame([(1, "n", 2.5)], "id long, v string, w double"), "t", on_schema_change="sync")
    assert store.read("t").columns == ["id", "v", "extra", "w"] and store.read("t").count() == 1


def test_sync_all_follows_the_batch(spark, store):
    have = T.StructType.fromDDL("id bigint, v string, n int, d decimal(10,2), day date")
    come = T.StructType.fromDDL("id bigint, n bigint, d decimal(12,4), day timestamp_ntz, extra boolean")
    found = types.schema_difference(have, come)
    assert found.removed == ["v"] and list(found.added) == ["extra"] and found.incompatible == {}
    assert {n: t.simpleString() for n, t in found.widened.items()} == {"n": "bigint", "d": "decimal(12,4)", "day": "timestamp_ntz"}
    assert types.synced_schema(have, come)[0].names == ["id", "n", "d", "day", "extra"]
    with pytest.raises(types.SchemaChanged, match="v is bigint"):
        types.synced_schema(T.StructType.fromDDL("v bigint"), T.StructType.fromDDL("v string"))
    with pytest.raises(types.SchemaChanged, match="must stay"):
        types.synced_schema(have, come, ["v"])
    rows_of = lambda: sorted(map(str, store.read("t").collect()))
    store.merge(spark.createDataFrame([(1, 5, "a"), (2, 6, "b")], "id long, n long, v string"), "t", order_by=None, buckets=4)
    store.merge(spark.createDataFrame([(2, 6.5)], "id long, n double"), "t", order_by=None, on_schema_change="sync_all")
    assert rows_of() == ["Row(id=1, n=5.0)", "Row(id=2, n=6.5)"]
    store.append(spark.createDataFrame([(3, 7.0, "c")], "id long, n double, v string"), "t", on_schema_change="sync_all")
    assert rows_of() == ["Row(id=1, n=5.0, v=None)", "Row(id=2, n=6.5, v=None)", "Row(id=3, n=7.0, v='c')"]  # The old v is gone for good.
    with pytest.raises(types.SchemaChanged):
        store.merge(spark.createDataFrame([(3, "x", "c")], "id long, n string, v string"), "t", on_schema_change="sync_all")
    with pytest.raises(types.SchemaChanged):
        types.align_to_schema(spark.range(1).selectExpr("id", "1 as v"), T.StructType.fromDDL("id bigint, v string"), "fail")


def test_cursor(spark):
    docs = batch(spark, [(i, "x", stamp(i)) for i in range(1, 6)])
    assert pages.incremental_extract(docs, None, stamp(2)).count() == 4
    since = pages.incremental_extract(docs, stamp(4), stamp(2))
    assert sorted(r["id"] for r in since.collect()) == [4, 5]
    assert pages.advance_cursor(since).first()[0] == stamp(5)
    timeless = docs.unionAll(batch(spark, [(9, "x", None)]))
    assert sorted(r["id"] for r in pages.incremental_extract(timeless, stamp(4)).collect()) == [4, 5, 9]
    assert pages.advance_cursor(since.limit(0), stamp(4)).first()[0] == stamp(4)


def orders(spark, rows):
    return spark.createDataFrame([(i, a, stamp(1), stamp(d)) for i, a, d in rows],
                                 "id int, amount int, createdAt timestamp_ntz, updatedAt timestamp_ntz")


def test_merge_load_follows_its_cursor(spark, store):
    amounts = lambda: {r["id"]: r["amount"] for r in raw_tables(store)["orders"].collect()}
    load({"orders": orders(spark, [(1, 10, 2), (2, 20, 5), (9, 90, 1)])}, store, initial=stamp(2))
    assert amounts() == {1: 10, 2: 20} and cursors(store) == {"orders": "2024-01-05 00:00:00"}
    # The initial timestamp no longer counts, rows before the cursor are not read, ties are.
    load({"orders": orders(spark, [(1, 11, 4), (2, 21, 5), (3, 30, 7)])}, store, initial=stamp(1))
    assert amounts() == {1: 10, 2: 21, 3: 30} and cursors(store) == {"orders": "2024-01-07 00:00:00"}
    load({"orders": orders(spark, [])}, store)
    assert cursors(store) == {"orders": "2024-01-07 00:00:00"} and amounts() == {1: 10, 2: 21, 3: 30}
    reset_cursors(store)
    load({"orders": orders(spark, [(1, 12, 4)])}, store, initial=stamp(1))
    assert amounts() == {1: 12, 2: 21, 3: 30}
    assert dict(store.read("raw/orders").dtypes)["amount"] == "bigint"


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_cursor_and_mark_survive_a_change_of_session_zone(spark, store, kind):
    docs = orders(spark, [(1, 10, 2), (2, 20, 5)]).withColumns({c: F.col(c).cast(kind) for c in ("createdAt", "updatedAt")})
    load({"users": docs}, store, initial="2024-01-01T00:00:00Z")
    mark = store.high_water("raw/users", "updatedAt")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        for start in (mark, cursors(store)["users"]):
            since = pages.incremental_extract(docs.withColumn("updatedAt", F.col("updatedAt")), start)
            assert [r["id"] for r in since.select("id").collect()] == [2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_other_dispositions(spark, store):
    docs = {"products": orders(spark, [(1, 10, 2)]), "users": orders(spark, [(5, 1, 1)])}
    assert load(docs, store, "replace") == {"products": 1, "users": 1}
    assert load(docs, store, "skip") == {"products": None, "users": None}
    assert load(docs, store, "append") == {"products": 2, "users": 2}
    assert load(docs, store, "replace")["products"] == 3
    assert raw_tables(store)["products"].count() == 1
    with pytest.raises(ValueError):
        load(docs, store, "upsert")
    assert store.drop_layer("raw") and store.list_tables("raw") == []


def write_page(folder, name, docs, pretty=False):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"docs": docs, "totalDocs": len(docs), "page": 1}, indent=2 if pretty else None))


def test_pages_keep_nested_values_as_json(spark, tmp_path):
    doc = {"id": 1, "customer": {"id": 7, "roles": ["customer"]}, "items": [{"id": "a", "product": 5}], "amount": 5,
           "createdAt": "2024-01-02T03:04:05.678Z", "updatedAt": "2024-01-02T03:04:05.678Z"}
    write_page(tmp_path / "p", "1.json", [doc, {**doc, "id": 2, "customer": None}], pretty=True)
    got = pages.read_collection_pages(spark, str(tmp_path / "p"), collection_schema("orders"), multi_line=True).orderBy("id").collect()
    assert [r["id"] for r in got] == [1, 2] and got[1]["customer"] is None
    assert json.loads(got[0]["customer"]) == doc["customer"] and json.loads(got[0]["items"]) == doc["items"]
    assert got[0]["createdAt"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)


def test_stream_resumes_from_its_checkpoint(spark, store, tmp_path):
    folder = tmp_path / "land"
    def user(i, name, day):
        when = f"2024-01-0{day}T00:00:00Z"
        return {"id": i, "name": name, "email": "e", "roles": ["customer"], "createdAt": when, "updatedAt": when}
    def run():
        documents = read_page_stream(spark, str(folder), collection_schema("users"), files_per_trigger=1)
        stream_upsert(documents, store, "users", str(tmp_path / "cp")).awaitTermination()
        return {r["id"]: r["name"] for r in store.read("users").collect()}
    write_page(folder, "1.json", [user(1, "a", 1), user(2, "b", 1)])
    assert run() == {1: "a", 2: "b"}
    done = store.versions("users")
    assert run() == {1: "a", 2: "b"} and store.versions("users") == done
    write_page(folder, "2.json", [user(2, "c", 2), user(3, "d", 2)])
    assert run() == {1: "a", 2: "c", 3: "d"}


def test_inspection(spark):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    assert [tuple(r) for r in inspect.describe_table(spark, df).collect()] == [(1, "id", "bigint"), (2, "v", "string")]
    assert inspect.preview(df).count() == 1 and len(COLLECTIONS) == 9


@pytest.fixture(scope="module")
def raw(spark):
    return workspace(spark, SF).raw


def facts(store, name):
    return sorted((tuple(r) for r in store.read(f"dev_marts/{name}").collect()), key=repr)


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "fact_transactions"])
def test_incremental_equals_full_refresh(spark, store, tmp_path, raw, name):
    cut = F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz")
    early = {**raw, "orders": raw["orders"].filter(F.col("updatedAt") < cut),
             "transactions": raw["transactions"].filter(F.col("updatedAt") < cut)}
    Lake(early, store, AS_OF, SPINE).run_models(name)
    assert 0 < len(facts(store, name))
    later = Lake(raw, store, AS_OF, SPINE)
    later.run_models(name)
    once = facts(store, name)
    later.run_models(name)
    assert facts(store, name) == once
    whole = TableStore(spark, f"{tmp_path}/whole")
    Lake(raw, whole, AS_OF, SPINE).run_models(name, full_refresh=True)
    assert facts(whole, name) == once


def test_incremental_into_an_empty_table_loads_everything(spark, store, raw):
    none = {**raw, "orders": raw["orders"].limit(0)}
    Lake(none, store, AS_OF, SPINE).run_models("fact_orders")
    Lake(raw, store, AS_OF, SPINE).run_models("fact_orders")
    assert store.read("dev_marts/fact_orders").count() == raw["orders"].count()


def test_run_models_by_layer_model_and_target(spark, store, raw):
    lake = Lake(raw, store, AS_OF, SPINE, target="prod")
    assert set(lake.run_models("staging").values()) == {None}
    assert spark.table("prod_staging_stg_orders").count() == 1500
    assert lake.run_models("dim_products") == {"dim_products": 1}
    assert set(lake.run_models("marts")) == set(MARTS) == {t.split("/")[1] for t in store.list_tables("prod_marts")}
    with pytest.raises(KeyError):
        lake.run_models("nothing")


def test_dimension_schema_change_fails(spark, store, raw):
    lake = Lake(raw, store, AS_OF, SPINE)
    lake.run_models("dim_customers")
    changed = lake.table("dim_customers").drop("customer_email")
    store.replace(changed, lake.location("dim_customers"))
    with pytest.raises(types.SchemaChanged):
        lake.run_models("dim_customers")
    lake.run_models("dim_customers", full_refresh=True)


def user_page(i, when="2024-01-01T00:00:00Z"):
    return {"id": i, "name": "n", "email": "e", "roles": ["customer"], "createdAt": when, "updatedAt": when}


def damaged_pages(folder):
    write_page(folder, "good.json", [user_page(1, "2024-01-05T00:00:00Z"), user_page(2)])
    write_page(folder, "pretty.json", [user_page(3)], pretty=True)
    (folder / "cut.json").write_text(json.dumps({"docs": [user_page(4), user_page(5)]})[:150])
    (folder / "id.json").write_text(json.dumps({"docs": [{**user_page(6), "id": "six"}, user_page(7)]}))
    (folder / "empty.json").write_text(json.dumps({"docs": []}))
    (folder / "other.json").write_text(json.dumps({"errors": ["unavailable"]}))


@pytest.mark.parametrize("bad", ["cut.json", "id.json", "pretty.json", "other.json"])
def test_a_bad_page_fails_the_read_and_the_stream(spark, store, tmp_path, bad):
    damaged_pages(tmp_path / "all")
    folder = tmp_path / "some"
    folder.mkdir()
    for name in ("good.json", "empty.json", bad):
        (folder / name).write_text((tmp_path / "all" / name).read_text())
    schema = collection_schema("users")
    with pytest.raises(Exception):
        pages.read_collection_pages(spark, str(folder), schema).collect()
    with pytest.raises(Exception):
        stream_upsert(read_page_stream(spark, str(folder), schema), store, "users", str(tmp_path / "cp")).awaitTermination()
    assert not store.exists("users")


def test_rejected_pages_are_shown_and_hold_the_cursor(spark, store, tmp_path):
    damaged_pages(tmp_path / "users")
    good = pages.read_collections(spark, str(tmp_path), ["users"], on_bad="reject")
    bad = pages.read_rejected(spark, str(tmp_path), ["users"])
    assert sorted(r["id"] for r in good["users"].collect()) == [1, 2]
    files = {r["path"].split("/")[-1] for r in bad["users"].collect()}
    assert files == {"pretty.json", "cut.json", "id.json", "other.json"}
    load(good, store, initial="2023-01-01T00:00:00Z", rejected=bad)
    assert "users" not in cursors(store) and store.read("raw/users").count() == 2
    load(good, store, initial="2023-01-01T00:00:00Z")
    assert cursors(store)["users"].startswith("2024-01-05")


def test_pretty_pages_stream_too(spark, store, tmp_path):
    write_page(tmp_path / "p", "1.json", [user_page(3)], pretty=True)
    documents = read_page_stream(spark, str(tmp_path / "p"), collection_schema("users"), multi_line=True)
    stream_upsert(documents, store, "users", str(tmp_path / "cp")).awaitTermination()
    assert [r["id"] for r in store.read("users").collect()] == [3]


def test_duplicate_documents_count_once_in_a_first_build(spark, store, raw):
    """Full refresh, first build and incremental build agree on documents that were loaded twice."""
    twice = {**raw, "orders": raw["orders"].unionByName(raw["orders"])}
    lake = Lake(twice, store, AS_OF)
    lake.run_models("fact_orders")
    once = sorted(map(str, lake.table("fact_orders").collect()))
    assert len({r["order_id"] for r in lake.table("fact_orders").collect()}) == len(once)
    lake.run_models("fact_orders")
    assert sorted(map(str, lake.table("fact_orders").collect())) == once
    lake.run_models("fact_orders", full_refresh=True)
    assert sorted(map(str, lake.table("fact_orders").collect())) == once


def test_undeclared_fields_reach_the_table(spark, store, tmp_path):
    """Every top-level field of the documents is read, loaded and streamed, not the declared ones alone."""
    extra = {"shippingAddress": {"city": "Köln", "zip": "007"}, "tags": [1, "a"], "points": 3, "rate": 1.5, "vip": True,
             "note": "5", "mixed": 1, "nothing": None, "a.b": 1}
    write_page(tmp_path / "users", "1.json", [{**user_page(1, "2024-02-01T00:00:00Z"), **extra}, user_page(2, "2024-02-01T00:00:00Z")])
    write_page(tmp_path / "users", "2.json", [{**user_page(3, "2024-02-01T00:00:00Z"), "mixed": "x", "rate": 2}])
    (tmp_path / "users" / "3.json").write_text(json.dumps({"docs": [{**user_page(4, "2024-02-01T00:00:00Z"), "twice": 0}]}).replace(
        '"twice": 0', '"twice": {"k": 1, "k": 2}'))
    declared = collection_schema("users").names
    for on_bad in pages.ON_BAD:
        found = pages.read_collections(spark, str(tmp_path), ["users"], on_bad=on_bad)
        kinds = dict(found["users"].dtypes)
        assert [*kinds] == [*declared, "a_b", "mixed", "note", "nothing", "points", "rate", "shippingAddress", "tags", "twice", "vip"]
        assert [kinds[c] for c in ("points", "rate", "vip", "note", "mixed")] == ["bigint", "double", "boolean", "string", "string"]
    load(found, store)
    rows = {r["id"]: r for r in raw_tables(store)["users"].collect()}
    first = rows[1]
    assert json.loads(first["shippingAddress"]) == extra["shippingAddress"] and json.loads(first["tags"]) == [1, "a"]
    assert (first["points"], first["rate"], first["vip"], first["note"], first["mixed"], first["a_b"]) == (3, 1.5, True, "5", "1", 1)
    assert rows[2]["points"] is None and rows[3]["mixed"] == "x" and rows[4]["twice"] == '{"k": 1, "k": 2}'
    stream = read_page_stream(spark, str(tmp_path / "users"), collection_schema("users"))
    stream_upsert(stream, store, "streamed", str(tmp_path / "cp")).awaitTermination()
    assert store.read("streamed").orderBy("id").collect() == raw_tables(store)["users"].orderBy("id").collect()
    write_page(tmp_path / "users", "5.json", [{**user_page(5, "2024-03-01T00:00:00Z"), "late": 1}])
    load(pages.read_collections(spark, str(tmp_path), ["users"]), store)
    assert "late" not in raw_tables(store)["users"].columns and raw_tables(store)["users"].count() == 5
    write_page(tmp_path / "users", "6.json", [{**user_page(6, "2024-04-01T00:00:00Z"), "points": 3.5}])
    with pytest.raises(Exception, match="whole numbers"):
        load(pages.read_collections(spark, str(tmp_path), ["users"]), store)
    write_page(tmp_path / "clash", "1.json", [{**user_page(1), "Name": "x"}])
    with pytest.raises(ValueError, match="share a column"):
        pages.read_collection_pages(spark, str(tmp_path / "clash"), collection_schema("users"))


def test_a_second_load_reads_the_new_file_alone(spark, store, tmp_path):
    for i in range(4):
        write_page(tmp_path / "users", f"{i}.json", [user_page(i, "2024-01-05T00:00:00Z")])
    assert load_landed(store, str(tmp_path), ["users"]) == {"users": 4}
    assert load_landed(store, str(tmp_path), ["users"]) == {"users": 0}
    write_page(tmp_path / "users", "4.json", [{**user_page(4), "late": 1.5}, {**user_page(0, "2023-01-01T00:00:00Z"), "name": "stale"}])
    (tmp_path / "users" / "0.json").rename(tmp_path / "gone")  # A file once loaded is not opened again.
    assert load_landed(store, str(tmp_path), ["users"]) == {"users": 1}
    found = {r["id"]: (r["name"], r["late"]) for r in raw_tables(store)["users"].collect()}
    assert found == {0: ("n", None), 1: ("n", None), 2: ("n", None), 3: ("n", None), 4: ("n", 1.5)}
    examined = store.read("state/fields")
    assert examined.count() == 5 and store.read("state/files").count() == 5
    write_page(tmp_path / "users", "1.json", [user_page(1, "2024-02-01T00:00:00Z"), user_page(9)])  # Changed in place.
    assert load_landed(store, str(tmp_path), ["users"], files_per_load=1) == {"users": 1}
    assert raw_tables(store)["users"].count() == 6
    Landing(store).forget()
    assert load_landed(store, str(tmp_path), ["users"], files_per_load=2) == {"users": 4}
    assert raw_tables(store)["users"].count() == 6


def test_rejected_files_stay_out_of_the_ledger(spark, store, tmp_path):
    damaged_pages(tmp_path / "users")
    with pytest.raises(Exception):
        load_landed(store, str(tmp_path), ["users"])
    assert not store.exists("state/files")
    assert load_landed(store, str(tmp_path), ["users"], on_bad="reject") == {"users": 6}
    assert sorted(r["id"] for r in raw_tables(store)["users"].collect()) == [1, 2]
    assert store.read("state/files").count() == 2
    write_page(tmp_path / "users", "cut.json", [user_page(4), user_page(5)])
    load_landed(store, str(tmp_path), ["users"], on_bad="reject", files_per_load=2)
    assert sorted(r["id"] for r in raw_tables(store)["users"].collect()) == [1, 2, 4, 5]


def test_known_pages_are_parsed_once(spark, store, tmp_path):
    write_page(tmp_path / "users", "1.json", [{**user_page(1), "points": 3}])
    landing = Landing(store)
    first = pages.read_collections(spark, str(tmp_path), ["users"], landing=landing)["users"]
    version = store.versions("state/fields")
    again = pages.read_collections(spark, str(tmp_path), ["users"], landing=landing)["users"]
    assert store.versions("state/fields") == version and again.collect() == first.collect()
    assert again._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1
    maps = [{"id": 1, **{f"k{i}": i for i in range(landing_module.MAX_FIELDS + 1)}}]
    write_page(tmp_path / "maps", "1.json", maps)
    with pytest.raises(ValueError, match="used as maps"):
        pages.read_collection_pages(spark, str(tmp_path / "maps"), collection_schema("users"))


def test_a_stream_takes_late_fields_and_any_order(spark, store, tmp_path):
    def run():
        stream = read_page_stream(spark, str(tmp_path / "land"), collection_schema("users"), files_per_trigger=1)
        stream_upsert(stream, store, "users", str(tmp_path / "cp"), buckets=4).awaitTermination()
        return {r["id"]: r.asDict() for r in store.read("users").collect()}
    write_page(tmp_path / "land", "1.json", [{**user_page(1, "2024-03-01T00:00:00Z"), "name": "new"}])
    assert run()[1]["name"] == "new"
    write_page(tmp_path / "land", "2.json", [{**user_page(1, "2024-02-01T00:00:00Z"), "name": "old"}, {**user_page(2), "vip": True}])
    found = run()
    assert found[1]["name"] == "new" and found[1]["vip"] is None and found[2]["vip"] is True


def test_text_keys_are_counted_by_hash(spark, store, monkeypatch):
    """Unique texts never move to be counted; where hashes are equal the texts decide."""
    counted, plain = [], tables.repeated_keys
    monkeypatch.setattr(tables, "repeated_keys", lambda df, keys: counted.append(list(keys)) or plain(df, keys))
    once = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 4)], "k string, v int")
    store.replace(once, "t", keys=["k"], order_by="v")
    assert counted == [["_hash"]] and store.read("t").count() == 4
    store.replace(once.unionAll(once.filter("k = 'a'").withColumn("v", F.lit(9))), "t", keys=["k"], order_by="v")
    assert ["k"] in counted and sorted(r["v"] for r in store.read("t").collect()) == [2, 3, 4, 9]
    monkeypatch.setattr(tables.F, "xxhash64", lambda *_: F.lit(7).cast("bigint"))
    store.replace(once, "u", keys=["k"], order_by="v")
    assert store.read("u").count() == 4
