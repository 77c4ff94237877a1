"""The lake over one folder of test tables: raw collections, stored marts, landed pages."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.plans.models import Lake
from storelake.sources.landing import Landing
from storelake.sources.tables import TableStore, shared_root
from storelake.sources.testtables import raw_collections, whole_orders

# The test orders end on 2001-08-01. The calendar follows the orders.
AS_OF = dt.date(2001, 8, 2)
SPINE = None
PAGE_SIZE = 1000

_open: dict[tuple[str, str], "Workspace"] = {}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        name = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
        self.root = f"{shared_root(spark)}/{name}"
        self.raw = raw_collections(spark, sf_dir)
        self.lake = Lake(self.raw, TableStore(spark, self.root), AS_OF, SPINE)
        # The same orders as documents that hold their lines.
        self.whole_orders = whole_orders(self.raw["orders"])
        self._landed: set[str] = set()

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def whole_lake(self, orders: DataFrame | None = None, store: TableStore | None = None) -> Lake:
        """A lake whose order documents hold all their lines."""
        raw = {**self.raw, "orders": self.whole_orders if orders is None else orders}
        del raw["order_fragments"]
        return Lake(raw, store or self.fresh_store(), AS_OF, SPINE)

    def fresh_store(self) -> TableStore:
        """An empty store for a query that shows a sink."""
        return TableStore(self.spark, f"{self.root}/runs/{uuid.uuid4().hex}")

    def landed(self, *collections: str) -> str:
        """Folder with page files of the collections."""
        folder = f"{self.root}/landing"
        for name in collections:
            if name not in self._landed:
                land(self.raw[name], f"{folder}/{name}", "overwrite")
                self._landed.add(name)
        return folder

    @property
    def landing(self) -> Landing:
        """What is known of the landed pages, kept between queries."""
        return Landing(self.lake.store)


def land(documents: DataFrame, folder: str, mode: str = "append", nested: tuple[str, ...] = ()) -> None:
    """Page files of documents, ``PAGE_SIZE`` to a page. Ids are unique, so a page is a bounded group.

    ``nested`` columns hold JSON text and land as the objects and lists they describe.
    """
    documents = documents.withColumns({c: F.parse_json(c) for c in nested})
    number = F.call_function("div", F.col("id"), F.lit(PAGE_SIZE)).alias("page")
    pages = documents.groupBy(number).agg(F.collect_list(F.struct(*documents.columns)).alias("docs"))
    pages.write.mode(mode).json(folder)


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """One per session and folder, so that stored marts are built once."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _open:
        _open[key] = Workspace(spark, key[1])
    return _open[key]


def name_id(name: str) -> int:
    """The id the adapter gives a category name."""
    return int(hashlib.md5(name.encode()).hexdigest()[:7], 16)
