"""The model list and its runner: staging stays lazy, marts become stored tables.

Facts build incrementally: only raw documents changed since the stored high-water mark are staged,
and the result is merged by key. The mark is resolved first, so it reaches the scan as a literal.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.dates import moment
from storelake.operators import marts, staging
from storelake.operators.numbering import written
from storelake.sources.schemas import CURSOR
from storelake.sources.tables import TableStore
from storelake.sources.types import align_to_schema

STAGING: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "stg_orders": ("orders", staging.stg_orders),
    "stg_order_items": ("order_fragments", staging.stg_order_items),
    "stg_transactions": ("transactions", staging.stg_transactions),
    "stg_carts": ("carts", staging.stg_carts),
    "stg_products": ("products", staging.stg_products),
    "stg_product_categories": ("products", staging.stg_product_categories),
    "stg_variants": ("variants", staging.stg_variants),
    "stg_categories": ("categories", staging.stg_categories),
    "stg_customers": ("users", staging.stg_customers),
}


@dataclass(frozen=True)
class Mart:
    name: str
    build: Callable[["Lake"], DataFrame]
    needs: tuple[str, ...] = ()
    unique_key: str | None = None
    watermark: tuple[str, ...] = ()
    on_schema_change: str = "align"
    month_of: str | None = None


def _fact_orders(lake: "Lake") -> DataFrame:
    if lake.whole_documents:
        return marts.fact_orders(staging.stg_orders(lake.raw["orders"], count_lines=True))
    return marts.fact_orders(lake.staged("stg_orders"), staging.line_counts(lake.raw["order_fragments"]))


def _fact_order_items(lake: "Lake") -> DataFrame:
    prices = lake.staged("stg_variants"), lake.staged("stg_products")
    if lake.whole_documents:
        return marts.fact_order_items(staging.stg_order_items(lake.raw["orders"], keep_stamps=True), None, *prices)
    return marts.fact_order_items(lake.staged("stg_order_items"), lake.staged("stg_orders"), *prices)


MARTS = {m.name: m for m in (
    Mart("fact_orders", _fact_orders,
         unique_key="order_id", watermark=("orders",), on_schema_change="sync_all",
         month_of="order_date"),
    Mart("fact_order_items", _fact_order_items,
         unique_key="order_item_id", watermark=("orders",), on_schema_change="sync_all", month_of="created_at"),
    Mart("fact_transactions", lambda l: marts.fact_transactions(l.staged("stg_transactions")),
         unique_key="transaction_id", watermark=("transactions",), on_schema_change="sync_all",
         month_of="transaction_date"),
    Mart("dim_customers", lambda l: marts.dim_customers(l.staged("stg_customers"), l.table("fact_orders"), l.as_of),
         needs=("fact_orders",), on_schema_change="fail"),
    Mart("dim_products", lambda l: marts.dim_products(l.staged("stg_products"))),
    Mart("dim_categories", lambda l: marts.dim_categories(l.staged("stg_categories"))),
    Mart("dim_date", lambda l: marts.dim_date(
        marts.date_bounds(l.spark, *l.spine) if l.spine else marts.covering_years(l.staged("stg_orders"), "created_at"))),
    Mart("bridge_product_categories", lambda l: marts.bridge_product_categories(l.staged("stg_product_categories"))),
)}


class Lake:
    """Raw collections, lazy staging and stored marts of one target namespace."""

    def __init__(self, raw: Mapping[str, DataFrame], store: TableStore, as_of: dt.date,
                 spine: tuple[dt.date, dt.date] | None = marts.SPINE, target: str = "dev"):
        # Without a spine the calendar covers the years of the orders.
        # An order document holds all its lines, unless the lines come apart as order fragments.
        self.whole_documents = "order_fragments" not in raw
        self.raw = {"order_fragments": raw["orders"], **raw} if self.whole_documents else dict(raw)
        self.store, self.as_of, self.spine, self.target = store, as_of, spine, target
        self.spark = store.spark

    def staged(self, name: str) -> DataFrame:
        source, project = STAGING[name]
        return project(self.raw[source])

    def location(self, mart: str) -> str:
        return f"{self.target}_marts/{mart}"

    def table(self, mart: str) -> DataFrame:
        """A stored mart, built on first use."""
        if not self.store.exists(self.location(mart)):
            self.run_models(mart)
        return self.store.read(self.location(mart))

    def changed_since(self, mark: str, collections: tuple[str, ...], strict: bool = False) -> "Lake":
        """The same lake restricted to documents changed since a mark.

        Ties at the mark are read again unless ``strict``: the keyed merge makes that harmless.
        """
        raw = dict(self.raw)
        for name in collections:
            start = moment(mark, raw[name].schema[CURSOR].dataType)
            raw[name] = raw[name].filter(F.col(CURSOR) > start if strict else F.col(CURSOR) >= start)
        if "orders" in collections:
            parts = raw.pop("order_fragments")
            if not self.whole_documents:
                # Written, so that their true size is known: few ids are broadcast, and the fragments stay where they are.
                raw["order_fragments"] = parts.join(written(raw["orders"].select("id")), "id", "left_semi")
        return Lake(raw, self.store, self.as_of, self.spine, self.target)

    def run_models(self, select: str | None = None, full_refresh: bool = False, strict: bool = False,
                   threads: int = 4) -> dict[str, int | None]:
        """Run everything, a layer (``staging``/``marts``) or one model; returns table versions.

        Staging models are views: they register as temporary views and have no version. Up to
        ``threads`` marts build at once, each after those it needs.
        """
        if select in (None, "staging") or select in STAGING:
            for name in STAGING if select in (None, "staging") else (select,):
                self.staged(name).createOrReplaceTempView(f"{self.target}_staging_{name}")
        if select is not None and select != "marts" and select not in MARTS:
            if select == "staging" or select in STAGING:
                return {n: None for n in (STAGING if select == "staging" else (select,))}
            raise KeyError(f"no such model or layer: {select}")
        chosen = [MARTS[select]] if select in MARTS else list(MARTS.values())
        versions: dict[str, int | None] = {}
        with ThreadPoolExecutor(threads) as pool:
            for wave in ([m for m in chosen if not m.needs], [m for m in chosen if m.needs]):
                built = pool.map(lambda m: self._build(m, full_refresh, strict), wave)
                versions.update(zip([m.name for m in wave], built))
        return versions

    def _build(self, mart: Mart, full_refresh: bool, strict: bool) -> int:
        for need in mart.needs:
            self.table(need)
        where = self.location(mart.name)
        stored = self.store.exists(where)
        parts = ["order_month"] if mart.month_of else []
        mark = None
        if mart.unique_key and stored and not full_refresh:
            mark = self.store.high_water(where, "updated_at")
        lake = self if mark is None else self.changed_since(mark, mart.watermark, strict)
        rows = mart.build(lake)
        if mart.month_of:
            rows = rows.withColumn("order_month", F.trunc(mart.month_of, "month"))
        if mark is not None:
            return self.store.merge(rows, where, [mart.unique_key], "updated_at", parts, mart.on_schema_change)
        if stored and not full_refresh and mart.on_schema_change == "fail":
            rows = align_to_schema(rows, self.store.schema(where), "fail")
        # As a merge would: raw tables may hold a document more than once.
        unique = [mart.unique_key] if mart.unique_key else []
        return self.store.replace(rows, where, parts, unique, "updated_at")
