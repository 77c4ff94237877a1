"""Pair counts against brute force, in the ordinary plan and with every kind of huge order."""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storelake.plans import affinity
from storelake.plans.affinity import _left_out, _split, baskets, pair_support, product_affinity


def brute(rows, support):
    orders = {}
    for order, product in rows:
        orders.setdefault(order, set()).add(product)
    counts = Counter(p for products in orders.values() for p in combinations(sorted(products), 2))
    return {p: n for p, n in counts.items() if n >= support}


def frames(spark, rows):
    items = spark.createDataFrame(rows, "order_id long, product_id long")
    orders = items.groupBy("order_id").agg(F.count("*").alias("item_count"))
    return items, orders


def counted(df):
    return {(r["a"], r["b"]): r["n"] for r in df.collect()}


ROWS = st.lists(st.tuples(st.integers(1, 12), st.integers(1, 9)), min_size=1, max_size=90)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, support=st.integers(1, 4), ordinary=st.integers(0, 8), few=st.booleans())
def test_any_split_into_ordinary_and_huge_gives_all_pairs(spark, rows, support, ordinary, few):
    items, orders = frames(spark, rows)
    found = pair_support(baskets(items), orders, support, ordinary, 10**6 if few else 0)
    assert counted(found) == brute(rows, support)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, limit=st.integers(1, 5), ordinary=st.integers(0, 5), probes=st.integers(2, 9))
def test_best_pairs_survive_the_raised_support(spark, rows, limit, ordinary, probes):
    items, orders = frames(spark, rows)
    products = spark.createDataFrame([(p, f"p{p}") for p in range(1, 8)], "product_id long, product_name string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(affinity, "PROBES", probes)
        report = affinity.product_affinity(items, orders, products, 2, limit, ordinary).collect()
    known = brute([r for r in rows if r[1] < 8], 2)
    want = sorted(known.items(), key=lambda p: (-p[1], p[0]))[:limit]
    assert [(r[0], r[1], r[2]) for r in report] == [(f"p{a}", f"p{b}", n) for (a, b), n in want]


def test_one_order_with_a_third_of_all_lines(spark):
    """It is left out for each of its products, so its 4.5 million pairs are never formed."""
    rows = [(0, p) for p in range(3000)]
    rows += [(o, (o * 7 + k * 11) % 3000) for o in range(1, 1501) for k in range(4)]
    items, orders = frames(spark, rows)
    found = pair_support(baskets(items), orders, 3)
    assert counted(found) == brute(rows, 3)
    sizes = orders.filter("item_count > 100")
    _, huge = _split(baskets(items), sizes.select("order_id"), few=True)
    kept = huge.join(_left_out(huge, sizes, 2), ["order_id", "product_id"], "left_anti")
    assert huge.count() == 3000 and kept.count() == 0


@pytest.mark.parametrize("ordinary", [0, 100])
def test_report(spark, ordinary):
    rows = [(o, p) for o in range(6) for p in (1, 2)] + [(o, 3) for o in range(3)] + [(9, 4), (9, 4)]
    items, orders = frames(spark, rows)
    products = spark.createDataFrame([(1, "bolt"), (2, "nut"), (3, "nut")], "product_id long, product_name string")
    got = [tuple(r) for r in product_affinity(items, orders, products, ordinary=ordinary).collect()]
    got = [(a, b, n, float(share)) for a, b, n, share in got]
    assert got == [("bolt", "nut", 6, 85.71), ("bolt", "nut", 3, 42.86), ("nut", "nut", 3, 42.86)]


def test_left_out_orders_are_counted_not_ranked(spark):
    """A hot product in many huge orders: at most the wanted number is left out, the largest first, and no window sorts its orders."""
    lines = [(o, p) for o in range(300) for p in (1, 2 + o % 5)]
    huge = spark.createDataFrame(lines, "order_id long, product_id long")
    sizes = spark.createDataFrame([(o, 200 + o // 30) for o in range(300)], "order_id long, item_count long")
    for most in (0, 5, 30, 45, 299, 300, 5000):
        out = affinity._left_out(huge, sizes, most)
        by_product = {}
        for r in out.collect():
            by_product.setdefault(r["product_id"], set()).add(r["order_id"])
        hot = by_product.get(1, set())
        assert len(hot) <= most and (len(hot) == min(most, 300) or most - len(hot) < 30)
        if hot:
            assert min(o // 30 for o in hot) >= max((o // 30 for o in set(range(300)) - hot), default=0)
    plan = affinity._left_out(huge, sizes, 5000)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan
