"""Reading landed collection pages and extracting what changed since a cursor.

Declared fields have their declared types. Every other top-level field of the documents is read too: its
type is found in one distributed pass over the pages, or comes from the catalogue of a ``Landing``, which
examines each file once. Only the field names reach the driver.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.functions.dates import moment
from storelake.sources.landing import Landing, field_kinds, page_texts, schemas_of_fields
from storelake.sources.schemas import (
    COLLECTIONS, CURSOR, INITIAL_TIMESTAMP, collection_schema, page_schema,
)

ON_BAD = ("fail", "reject")
_BAD = "_unparsed_page"


def found_schema(spark: SparkSession, path: str | list[str], documents: T.StructType, multi_line: bool = False,
                 landing: Landing | None = None, collection: str = "") -> T.StructType:
    """The declared fields, then by name every other top-level field of the landed documents.

    Whole numbers are bigint, other numbers double, nested values and mixed types text. Pages that do
    not parse add nothing: the read itself fails on them or rejects them.
    """
    if landing:
        return _unclashing(landing.schema(collection, path, documents, multi_line), path)
    fields = field_kinds(page_texts(spark, path, multi_line)).withColumn("collection", F.lit(collection))
    return _unclashing(schemas_of_fields(fields, {collection: documents})[collection], path)


def _unclashing(schema: T.StructType, path: str | list[str]) -> T.StructType:
    columns = [_column(n).lower() for n in schema.names]
    clashing = [n for n, c in zip(schema.names, columns) if columns.count(c) > 1]
    if clashing:
        raise ValueError(f"fields of {path} that would share a column: {', '.join(clashing)}")
    return schema


def _column(field: str) -> str:
    """Column of a field: signs that a column name cannot hold become underscores."""
    return re.sub(r"\W", "_", field)


def read_collection_pages(
    spark: SparkSession, path: str | list[str], documents: T.StructType, multi_line: bool = False, on_bad: str = "fail",
    landing: Landing | None = None, collection: str = "",
) -> DataFrame:
    """One row per document from page files ``{"docs": [...], "page": n, ...}``, with all its top-level fields.

    ``documents`` declares the fields whose type is known. Pages are one JSON object per line (splittable) unless ``multi_line`` says a file holds a
    single pretty-printed page. Nested values of a string field arrive as JSON text. A page that does
    not parse, holds a value of the wrong type, or has no ``docs`` fails the read; ``on_bad="reject"``
    leaves such pages out whole, for ``read_rejected_pages`` to show. With a ``landing`` the fields come
    from its catalogue for that ``collection``, so that pages it knows are parsed once, for their values.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {', '.join(ON_BAD)}")
    return parsed_pages(spark, path, found_schema(spark, path, documents, multi_line, landing, collection), multi_line, on_bad)


def parsed_pages(spark: SparkSession, path: str | list[str], fields: T.StructType, multi_line: bool = False,
                 on_bad: str = "fail") -> DataFrame:
    """The documents of pages whose fields are known, in one pass."""
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {', '.join(ON_BAD)}")
    if on_bad == "reject":
        return documents_of(_marked_pages(spark, path, fields, multi_line).filter(~_rejected()))
    reader = spark.read.schema(page_schema(fields)).option("multiLine", multi_line).option("mode", "FAILFAST")
    return documents_of(reader.option("recursiveFileLookup", True).json(path))


def documents_of(pages: DataFrame) -> DataFrame:
    """The documents of parsed pages; a page without ``docs`` is an error, an empty list is none."""
    lacking = F.raise_error(F.lit("a landed page has no docs")).cast(pages.schema["docs"].dataType)
    fields = pages.schema["docs"].dataType.elementType.names
    return pages.select(F.inline(F.coalesce("docs", lacking))).toDF(*[_column(f) for f in fields])


def read_rejected_pages(
    spark: SparkSession, path: str | list[str], documents: T.StructType, multi_line: bool = False,
    landing: Landing | None = None, collection: str = "",
) -> DataFrame:
    """(path, page): the file and text of every page that ``on_bad="reject"`` leaves out."""
    documents = found_schema(spark, path, documents, multi_line, landing, collection)
    marked = _marked_pages(spark, path, documents, multi_line).filter(_rejected())
    return marked.select("path", F.coalesce(_BAD, F.lit("no docs")).alias("page"))


def _rejected() -> Column:
    return F.col(_BAD).isNotNull() | F.col("docs").isNull()


def _marked_pages(spark: SparkSession, path: str | list[str], documents: T.StructType, multi_line: bool) -> DataFrame:
    schema = T.StructType([*page_schema(documents).fields, T.StructField(_BAD, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("columnNameOfCorruptRecord", _BAD)
    # Both columns are used in every plan: the parser skips what nobody asks for, and with it the errors.
    return reader.option("recursiveFileLookup", True).json(path).select("docs", _BAD, F.col("_metadata.file_path").alias("path"))


def read_collections(
    spark: SparkSession, root: str, names: Iterable[str] = tuple(COLLECTIONS), zoned: bool = True,
    multi_line: bool = False, on_bad: str = "fail", landing: Landing | None = None,
) -> dict[str, DataFrame]:
    """The named collections below ``root/<collection>/``. With a ``landing`` their files are listed and examined together."""
    folders = {name: f"{root}/{name}" for name in names}
    declared = {name: collection_schema(name, zoned) for name in names}
    if not landing:
        return {name: read_collection_pages(spark, path, declared[name], multi_line, on_bad) for name, path in folders.items()}
    fields = landing.schemas(folders, declared, multi_line)
    return {name: parsed_pages(spark, path, _unclashing(fields[name], path), multi_line, on_bad) for name, path in folders.items()}


def read_rejected(
    spark: SparkSession, root: str, names: Iterable[str] = tuple(COLLECTIONS), zoned: bool = True,
    multi_line: bool = False,
) -> dict[str, DataFrame]:
    """The rejected pages of the named collections."""
    return {
        name: read_rejected_pages(spark, f"{root}/{name}", collection_schema(name, zoned), multi_line)
        for name in names
    }


def incremental_extract(
    documents: DataFrame,
    cursor: dt.datetime | str | None,
    initial: dt.datetime | str = INITIAL_TIMESTAMP,
    cursor_column: str = CURSOR,
) -> DataFrame:
    """Documents changed at or after the saved cursor; ``initial`` serves the first run only.

    Documents that don't say when they changed come along every time: a keyed merge takes them where it
    has nothing newer.
    """
    start = moment(initial if cursor is None else cursor, documents.schema[cursor_column].dataType)
    return documents.filter((F.col(cursor_column) >= start) | F.col(cursor_column).isNull())


def advance_cursor(
    extracted: DataFrame, cursor: dt.datetime | str | None = None, cursor_column: str = CURSOR,
) -> DataFrame:
    """One row with the cursor to save; an empty extract keeps the previous one."""
    kind = extracted.schema[cursor_column].dataType
    previous = F.lit(None).cast(kind) if cursor is None else moment(cursor, kind)
    return extracted.agg(F.coalesce(F.max(cursor_column), previous).alias("cursor"))


def debug_sample(
    collections: dict[str, DataFrame], names: Iterable[str] = ("orders", "products"), rows: int = 10,
) -> dict[str, DataFrame]:
    """First ``rows`` documents of a few collections, oldest first."""
    return {n: collections[n].orderBy("createdAt", "id").limit(rows) for n in names}
