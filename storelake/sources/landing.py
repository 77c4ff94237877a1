"""What is known of landed page files: which were loaded, and which fields they hold.

Two stored tables keep this between loads. The ledger lists the files that a collection was loaded from, so that
a load reads the files landed since. The catalogue holds a sketch per file, its fields with the kinds of their
values; a file is examined once, and sketches are united by a lattice of types. A file that was changed in place
(another length or time) is new to both.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.sources.tables import TableStore

_FILE = ["collection", "path", "length", "modified"]
_LEDGER, _FIELDS = "state/files", "state/fields"
_TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType()}
MAX_FIELDS = 2000  # Columns that a table may have; documents with more fields are used as maps.
FILES_PER_LOAD = 10_000


def landed_files(spark: SparkSession, path: str | Iterable[str]) -> DataFrame:
    """(path, length, modified) of the files below a folder, or of the given files; the time in microseconds. Contents are not read."""
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def page_texts(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    """(path, page): one row per page; ``multi_line`` takes a file for a single page."""
    lines = spark.read.option("wholetext", multi_line).option("recursiveFileLookup", True).text(paths)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("page"))


def _kind(value: Column) -> Column:
    """Type of a JSON value: BIGINT, DOUBLE, BOOLEAN, VOID, or STRING for texts, nested values and numbers that no double holds."""
    name = F.schema_of_variant(value)
    digits = F.regexp_extract(name, r"^DECIMAL\((\d+),", 1)
    return F.when(digits != "", F.when(digits.cast("int") <= 15, "DOUBLE").otherwise("STRING")) \
        .when(name.isin(*_TYPES, "VOID"), name).otherwise("STRING")


def field_kinds(pages: DataFrame) -> DataFrame:
    """(path, name, kinds) from (path, page), in one pass: the top-level fields of all documents.

    A page that does not parse adds nothing. One that a variant refuses, because a value repeats a key, adds
    the names of its fields without a kind.
    """
    typed = F.transform(F.flatten(F.transform(F.from_json("page", "docs array<map<string,variant>>")["docs"], F.map_entries)),
                        lambda e: F.struct(e["key"].alias("name"), _kind(e["value"]).alias("kind")))
    named = F.transform(F.flatten(F.transform(F.from_json("page", "docs array<map<string,string>>")["docs"], F.map_entries)),
                        lambda e: F.struct(e["key"].alias("name"), F.lit("VOID").alias("kind")))
    fields = pages.select("path", F.explode(F.array_distinct(F.coalesce(typed, named))).alias("field"))
    return fields.groupBy("path", F.col("field.name").alias("name")).agg(F.collect_set("field.kind").alias("kinds"))


def united(kinds: Iterable[str]) -> T.DataType:
    """The least type that holds values of all kinds: whole numbers below numbers, all below text."""
    known = set(kinds) - {"VOID"}
    if known == {"BIGINT", "DOUBLE"}:
        known = {"DOUBLE"}
    return _TYPES.get(known.pop(), T.StringType()) if len(known) == 1 else T.StringType()


def schemas_of_fields(fields: DataFrame, declared: Mapping[str, T.StructType]) -> dict[str, T.StructType]:
    """The declared fields, then by name every other one of (collection, name, kinds), for each declared collection."""
    named = [F.struct(F.lit(c).alias("collection"), F.lit(n).alias("name")) for c, schema in declared.items() for n in schema.names]
    others = fields.filter(~F.struct("collection", "name").isin(*named)).groupBy("collection", "name").agg(
        F.array_distinct(F.flatten(F.collect_set("kinds"))).alias("kinds"))
    rows = others.limit(MAX_FIELDS * len(declared) + 1).collect()
    out = {}
    for collection, documents in declared.items():
        found = sorted((r["name"], r["kinds"]) for r in rows if r["collection"] == collection)
        if len(found) > MAX_FIELDS:
            raise ValueError(f"more than {MAX_FIELDS} top-level fields: the documents are used as maps")
        out[collection] = T.StructType([*documents.fields, *[T.StructField(n, united(kinds)) for n, kinds in found]])
    return out


class Landing:
    """The ledger and the field catalogue of one store."""

    def __init__(self, store: TableStore):
        self.store, self.spark = store, store.spark

    def _known(self, table: str, collection: str) -> DataFrame | None:
        if not self.store.exists(table):
            return None
        return self.store.read(table).filter(F.col("collection") == collection)

    def _unknown(self, table: str, collection: str, files: DataFrame) -> DataFrame:
        known = self._known(table, collection)
        found = files.select(F.lit(collection).alias("collection"), "path", "length", "modified")
        return found if known is None else found.join(known.select(*_FILE), _FILE, "left_anti")

    def new_files(self, collection: str, path: str, limit: int = FILES_PER_LOAD) -> list[Row]:
        """The oldest files that were not loaded, at most ``limit``, as (path, length, modified)."""
        fresh = self._unknown(_LEDGER, collection, landed_files(self.spark, path))
        return fresh.orderBy("modified", "path").limit(limit).select("path", "length", "modified").collect()

    def loaded(self, collection: str, files: list[Row]) -> None:
        """Enter files in the ledger as they were listed, once what they hold is stored."""
        if files:
            rows = self.spark.createDataFrame(files, "path string, length long, modified long")
            self.store.append(rows.select(F.lit(collection).alias("collection"), "path", "length", "modified"), _LEDGER)

    def forget(self) -> None:
        """Start over: the next load reads all files. What is known of their fields stays."""
        self.store.drop(_LEDGER)

    def schemas(self, folders: Mapping[str, str | list[str]], declared: Mapping[str, T.StructType],
                multi_line: bool = False) -> dict[str, T.StructType]:
        """Fields per collection, all that its files had so far; files not seen before are examined first.

        One listing, and one pass over the sketches, for all collections.
        """
        def fresh() -> list[Row]:
            parts = [landed_files(self.spark, path).withColumn("collection", F.lit(c)) for c, path in folders.items()]
            every = reduce(DataFrame.unionByName, parts).select(*_FILE)
            if self.store.exists(_FIELDS):
                every = every.join(self.store.read(_FIELDS).select(*_FILE), _FILE, "left_anti")
            return every.limit(FILES_PER_LOAD).collect()

        while files := fresh():
            paths = [f["path"] for f in files]
            found = field_kinds(page_texts(self.spark, paths, multi_line))
            sketches = found.groupBy("path").agg(F.collect_list(F.struct("name", "kinds")).alias("fields"))
            rows = self.spark.createDataFrame(files, "collection string, path string, length long, modified long")
            self.store.append(rows.join(sketches, "path", "left").select(*_FILE, "fields"), _FIELDS)
        if not self.store.exists(_FIELDS):
            return dict(declared)
        known = self.store.read(_FIELDS).filter(F.col("collection").isin(*folders))
        return schemas_of_fields(known.select("collection", F.explode("fields").alias("f")).select("collection", "f.*"), declared)

    def schema(self, collection: str, paths: str | list[str], documents: T.StructType, multi_line: bool = False) -> T.StructType:
        return self.schemas({collection: paths}, {collection: documents}, multi_line)[collection]
