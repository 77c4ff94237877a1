"""Products bought together.

Pairs are counted by joining the lines of an order with each other. That is quadratic in the order,
which is harmless for ordinary baskets and ruinous for a few huge ones. Huge baskets are therefore
never paired in full; they are handled exactly by prefix filtering:

* Put all orders in one sequence, ordinary ones first, then huge ones by size and a hash.
* For a pair to reach support ``s`` the two products share at least ``s`` orders. The earliest of
  those is not among the last ``s - 1`` orders of either product. So pairs found after leaving out
  each product's last ``s - 1`` huge orders include every pair that can qualify.
* The left-out orders, at most ``s - 1`` per product, are then checked for the pairs found.

A top list needs only its best pairs, so ``s`` first rises to a support they are sure to reach. The more
unevenly products sell and the more huge baskets overlap, the higher it gets and the fewer pairs are
formed.

One order that holds a third of all lines is the last order of each of its products, so with ``s > 1``
it is left out everywhere and only looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.functions.money import percent
from storelake.operators.numbering import written

# Fixed values of the report.
MIN_SUPPORT, TOP = 3, 20
# Baskets of up to this many lines are paired directly; larger ones are prefix filtered.
ORDINARY_BASKET = 100
# Order ids that may be broadcast: 8 MB. The number is counted before.
BROADCAST_IDS = 1_000_000
# Hash buckets that tell apart huge orders of one size.
BUCKETS = 1024
# Orders of more lines are few, at most one for so many lines; their ids are broadcast, so that no join on orders is skewed.
GIANT = 20_000
# Pairs that a task forms, more or less, before it hands on their counts.
PAIRS_PER_TASK = 500_000
# Products with the most lines, whose pairs set the support floor of a top list.
PROBES = 64


def baskets(items: DataFrame) -> DataFrame:
    """Distinct (order, product) pairs, reduced before any join so that a hot product spreads out."""
    lines = items.select("order_id", "product_id")
    return lines.filter(F.col("order_id").isNotNull() & F.col("product_id").isNotNull()).distinct()


def _paired(lines: DataFrame, tasks: int = 1) -> DataFrame:
    """Pairs of each order with their counts. With more than one of ``tasks`` the orders are dealt to so many."""
    if tasks > 1:
        lines = lines.repartition(tasks, "order_id")
    a = lines.select("order_id", F.col("product_id").alias("a"))
    b = lines.select("order_id", F.col("product_id").alias("b"))
    together = a.join(b, "order_id").filter("a < b")
    return together.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def _split(lines: DataFrame, ids: DataFrame, few: bool) -> tuple[DataFrame, DataFrame]:
    """Lines of ordinary and of huge orders; a few ids are broadcast."""
    if few:
        ids = F.broadcast(ids)
    return lines.join(ids, "order_id", "left_anti"), lines.join(ids, "order_id", "left_semi")


def _with_size(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """Lines with the ``item_count`` of their huge order, NULL in an ordinary one. Each line moves once."""
    giants = F.broadcast(sizes.filter(F.col("item_count") > GIANT))
    others = sizes.filter(F.col("item_count") <= GIANT)
    rest = lines.join(giants, "order_id", "left_anti").join(others, "order_id", "left")
    return rest.unionByName(lines.join(giants, "order_id"))


def _left_out(huge: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of each product's last huge orders, by size and then by a hash of the order.

    Orders are counted, not ranked, so that no task sorts all orders of a much sold product: first by size
    (a product has few different ones: their sum is at most its lines), then, where ``most`` falls among
    orders of one size, by their hash. Leaving out fewer than ``most`` is safe.
    """
    sized = huge if "item_count" in huge.columns else huge.join(sizes, "order_id")
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("order_id"), F.lit(BUCKETS)))
    by_size = Window.partitionBy("product_id").orderBy(F.desc("item_count"))
    counted = sized.groupBy("product_id", "item_count").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "upto", F.sum("n").over(by_size))
    whole = counted.filter(F.col("upto") <= most).select("product_id", "item_count")
    room = F.lit(most) - F.col("upto") + F.col("n")
    cut = counted.filter((F.col("upto") > most) & (room > 0)).select("product_id", "item_count", room.alias("room"))
    of_size = ["product_id", "item_count"]
    by_hash = Window.partitionBy(*of_size).orderBy("bucket")
    parts = sized.join(cut, of_size).groupBy(*of_size, "bucket", "room").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "upto", F.sum("n").over(by_hash)).filter(F.col("upto") <= F.col("room")).select(*of_size, "bucket")
    last = sized.join(whole, of_size, "left_semi").unionByName(sized.join(parts, [*of_size, "bucket"], "left_semi"))
    return last.select("order_id", "product_id")


def _reachable(found: DataFrame, huge: DataFrame, support: int) -> DataFrame:
    """Pairs that can still reach the support; ``reach`` bounds the huge orders they may share."""
    held = huge.groupBy("product_id").agg(F.count(F.lit(1)).alias("held"))
    bounded = found.join(held.toDF("a", "held_a"), "a", "left").join(held.toDF("b", "held_b"), "b", "left")
    reach = F.least(F.coalesce("held_a", F.lit(0)), F.coalesce("held_b", F.lit(0)))
    return bounded.select("a", "b", "n", reach.alias("reach")).filter(F.col("n") + F.col("reach") >= support)


def _late(pairs: DataFrame, left_out: DataFrame, huge: DataFrame) -> DataFrame:
    """Left-out orders that hold both products of a pair."""
    hits = []
    for mine, other in (("a", "b"), ("b", "a")):
        candidates = pairs.join(left_out.withColumnRenamed("product_id", mine), mine)
        present = huge.withColumnRenamed("product_id", other)
        hits.append(candidates.join(present, ["order_id", other], "left_semi").select("a", "b", "order_id"))
    return hits[0].unionAll(hits[1]).distinct().select("a", "b", F.lit(1).cast("bigint").alias("n"))


def pair_support(lines: DataFrame, orders: DataFrame, support: int = MIN_SUPPORT, ordinary: int = ORDINARY_BASKET,
                 broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """``a, b, n``: product pairs in at least ``support`` orders, from distinct basket lines.

    Counts the huge orders and the pairs first, one narrow column scan, to choose the plan.
    """
    sizes = orders.filter(F.col("item_count") > ordinary).select("order_id", "item_count")
    n = F.col("item_count")
    # The pairs of a huge order are mostly left out; the number only says how many tasks form them.
    formed = F.least(n * (n - 1) / 2, n * ORDINARY_BASKET)
    n_huge, pairs = orders.agg(F.count_if(n > ordinary), F.coalesce(F.sum(formed), F.lit(0.0))).first()
    tasks = 1 + int(pairs / PAIRS_PER_TASK)
    if n_huge == 0:
        return _paired(lines, tasks).filter(F.col("n") >= support)

    if n_huge <= broadcast_ids:
        small, huge = _split(lines, sizes.select("order_id"), few=True)
        huge = written(huge)  # Read five times.
    else:
        known = written(_with_size(lines, sizes))
        small, huge = known.filter("item_count is null").drop("item_count"), known.filter("item_count is not null")
    left_out = _left_out(huge, sizes, support - 1)
    huge = huge.select("order_id", "product_id")
    kept = huge.join(left_out, ["order_id", "product_id"], "left_anti")
    found = _reachable(_paired(small.unionByName(kept), tasks), huge, support)
    late = _late(found.filter("reach > 0").select("a", "b"), left_out, huge)
    total = found.select("a", "b", "n").unionAll(late).groupBy("a", "b").agg(F.sum("n").alias("n"))
    return total.filter(F.col("n") >= support)


def _support_floor(items: DataFrame, frequent: DataFrame, support: int, best: int) -> int:
    """A support that at least ``best`` pairs reach, so that no rarer pair is among the best.

    The pairs among a few dozen of the products with the most lines are counted exactly. Their ids go
    into the scan as literals.
    """
    probe = [r[0] for r in frequent.orderBy(F.desc("lines"), "product_id").limit(PROBES).collect()]
    pairs = _paired(baskets(items.filter(F.col("product_id").isin(probe)))).filter(F.col("n") >= support)
    last = pairs.orderBy(F.desc("n")).limit(best).agg(F.count(F.lit(1)), F.min("n")).first()
    return last[1] if last[0] == best else support


def product_affinity(items: DataFrame, orders: DataFrame, products: DataFrame, min_support: int = MIN_SUPPORT,
                     limit: int = TOP, ordinary: int = ORDINARY_BASKET) -> DataFrame:
    """Most frequent pairs with their share of all orders. Names join the few rows that remain.

    Two narrow passes over the lines find a support that the top list is sure to reach. A product with
    fewer lines than that is in no pair of the list, and is left out before any pair is formed.
    """
    named_ids = products.select("product_id")
    lines_of = items.groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))
    frequent = lines_of.join(named_ids, "product_id", "left_semi")
    support = _support_floor(items, frequent, min_support, limit)
    wanted = frequent.filter(F.col("lines") >= support).select("product_id") if support > min_support else named_ids
    known = baskets(items).join(wanted, "product_id", "left_semi")
    best = pair_support(known, orders, support, ordinary).orderBy(F.desc("n"), "a", "b").limit(limit)
    names = products.select("product_id", "product_name")
    named = best.join(names.toDF("a", "product_a"), "a").join(names.toDF("b", "product_b"), "b")
    all_orders = orders.agg(F.count("order_id")).scalar()
    return named.orderBy(F.desc("n"), "a", "b").select(
        "product_a", "product_b", F.col("n").alias("times_bought_together"),
        percent(F.col("n"), all_orders).alias("frequency_percentage"))
