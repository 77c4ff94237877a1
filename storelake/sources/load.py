"""Loading collections into raw tables under one of four write dispositions.

A merge load is incremental: it extracts from the saved cursor, merges, then saves the new cursor. A
load that fails in between is repeated from the old cursor, which the keyed merge makes harmless.

``load_landed`` loads page files. Its cursor is a ledger of the files: a load reads those that landed since
the last one, whatever the times in them, and enters them once their documents are stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.sources.landing import FILES_PER_LOAD, Landing
from storelake.sources.pages import found_schema, incremental_extract, parsed_pages, read_rejected_pages
from storelake.sources.schemas import COLLECTIONS, CURSOR, INITIAL_TIMESTAMP, PRIMARY_KEY, collection_schema
from storelake.sources.tables import TableStore
from storelake.sources.types import map_types

# The write dispositions.
DISPOSITIONS = ("skip", "append", "replace", "merge")
# Collections that grow without end are stored by month of creation, so a merge rewrites few months.
BY_MONTH = ("orders", "transactions", "carts")
MONTH = "created_month"
# The other keyed collections are stored by bucket of their key, so a merge rewrites the buckets it touches.
KEY_BUCKETS = {"users": 32, "products": 32, "variants": 32}
_STATE = "state/cursors"


def cursors(store: TableStore) -> dict[str, str]:
    """Saved cursor per collection, as text; one row each."""
    if not store.exists(_STATE):
        return {}
    return {r["collection"]: r["cursor"] for r in store.read(_STATE).collect()}


def reset_cursors(store: TableStore) -> None:
    """Start over from the initial timestamp at the next load."""
    store.drop(_STATE)


def _save_cursor(store: TableStore, collection: str, value: str) -> None:
    row = store.spark.createDataFrame([(collection, value)], "collection string, cursor string")
    store.merge(row, _STATE, ["collection"], None)


def load(collections: Mapping[str, DataFrame], store: TableStore, disposition: str = "merge",
         initial: dt.datetime | str = INITIAL_TIMESTAMP, layer: str = "raw",
         rejected: Mapping[str, DataFrame] | None = None, on_schema_change: str = "align") -> dict[str, int | None]:
    """Write each collection to ``layer/<name>``; returns the new version, None where skipped.

    ``on_schema_change="sync"`` lets a merge add the fields that the table lacks.

    A collection with ``rejected`` pages keeps its cursor: what they hold may be older than what was read,
    and is read once the pages are mended. The keyed merge makes reading the others again harmless.
    """
    if disposition not in DISPOSITIONS:
        raise ValueError(f"disposition must be one of {', '.join(DISPOSITIONS)}")
    saved, versions = cursors(store), {}
    for name, documents in collections.items():
        table = f"{layer}/{name}"
        if disposition != "merge":
            versions[name] = getattr(store, disposition)(_placed(documents, name), table, _parts(name))
            continue
        rows = incremental_extract(documents, saved.get(name), initial)
        versions[name] = _merge(rows, store, name, layer, on_schema_change)
        # From the stored rows, which hold the batch: the pages are not parsed again.
        latest = store.high_water(table, CURSOR)
        if latest is not None and not (rejected and name in rejected and not rejected[name].isEmpty()):
            _save_cursor(store, name, latest)
    return versions


def _parts(name: str) -> list[str]:
    return [MONTH] if name in BY_MONTH else []


def _placed(documents: DataFrame, name: str) -> DataFrame:
    """The rows as stored, with the column that places them."""
    stored = map_types(documents)
    if name not in BY_MONTH:
        return stored
    if MONTH in stored.columns:
        raise ValueError(f"{name} has a field {MONTH}, which is the column that places its rows")
    return stored.withColumn(MONTH, F.trunc(F.to_date("createdAt"), "month"))


def _merge(documents: DataFrame, store: TableStore, name: str, layer: str, on_schema_change: str) -> int:
    return store.merge(_placed(documents, name), f"{layer}/{name}", [PRIMARY_KEY], CURSOR, _parts(name), on_schema_change,
                       KEY_BUCKETS.get(name, 0))


def load_landed(store: TableStore, root: str, names: Iterable[str] = tuple(COLLECTIONS), layer: str = "raw",
                zoned: bool = True, multi_line: bool = False, on_bad: str = "fail", on_schema_change: str = "sync",
                files_per_load: int = FILES_PER_LOAD) -> dict[str, int]:
    """Merge the page files that landed below ``root/<collection>/`` since the last load; returns how many were read.

    Of a key's documents the newest stays, whatever the order in which pages land. Each file is examined
    once for fields that are not known yet and parsed once; a new field widens the table. A page that does
    not parse fails the load; with ``on_bad="reject"`` its good documents' pages are merged and the file
    stays out of the ledger, so that it is read again once it was mended. A load that ends early is
    repeated, which the keyed merge makes harmless. Files are taken in turns of ``files_per_load``.
    """
    landing, counts = Landing(store), {}
    for name in names:
        counts[name], declared, held = 0, collection_schema(name, zoned), set()
        while True:
            files = landing.new_files(name, f"{root}/{name}", files_per_load + len(held))
            files = [f for f in files if f["path"] not in held]
            if not files:
                break
            paths = [f["path"] for f in files]
            fields = found_schema(store.spark, paths, declared, multi_line, landing, name)
            _merge(parsed_pages(store.spark, paths, fields, multi_line, on_bad), store, name, layer, on_schema_change)
            if on_bad == "reject":
                bad = read_rejected_pages(store.spark, paths, declared, multi_line, landing, name)
                held |= {r["path"] for r in bad.select("path").distinct().collect()}
            landing.loaded(name, [f for f in files if f["path"] not in held])
            counts[name] += len(files)
    return counts


def raw_tables(store: TableStore, layer: str = "raw") -> dict[str, DataFrame]:
    """The loaded collections, without the column that only places them."""
    return {t.split("/")[-1]: store.read(t).drop(MONTH) for t in store.list_tables(layer)}
