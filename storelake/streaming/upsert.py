"""Landed pages as a stream: the checkpoint is the cursor, each micro-batch is a keyed merge.

The stream carries the names of landed files. A micro-batch examines its files for fields that were not seen
before, parses them with all fields known by then, and merges: late fields widen the table, and of a key's rows
the newest stays, so that pages may land in any order. A repeated batch after a failure merges the same rows
again, so the table ends up the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelake.sources.landing import Landing
from storelake.sources.pages import found_schema, parsed_pages
from storelake.sources.schemas import CURSOR, PRIMARY_KEY
from storelake.sources.tables import TableStore

# What the file source says of a file; contents are read by the micro-batch.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass(frozen=True)
class LandedPages:
    """Page files as they land, and how their documents are read."""
    files: DataFrame
    documents: T.StructType
    multi_line: bool = False

    def parsed(self, paths: list[str], landing: Landing, name: str) -> DataFrame:
        fields = found_schema(landing.spark, paths, self.documents, self.multi_line, landing, name)
        return parsed_pages(landing.spark, paths, fields, self.multi_line)


def read_page_stream(spark: SparkSession, path: str, documents: T.StructType, files_per_trigger: int = 1000,
                     multi_line: bool = False) -> LandedPages:
    """Newly landed pages, with the declared fields and whatever others they hold. A page that does not parse
    stops the stream before its batch is marked as done, so nothing is lost: mend or move the file and start again."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_trigger)
    return LandedPages(reader.load(path).select("path"), documents, multi_line)


def stream_upsert(pages: LandedPages, store: TableStore, name: str, checkpoint: str,
                  keys: Sequence[str] = (PRIMARY_KEY,), order_by: str = CURSOR,
                  partition_by: Sequence[str] = (), buckets: int = 0) -> StreamingQuery:
    """Upsert everything landed so far into a table and stop. The fields known so far are kept in the store."""
    landing = Landing(store)

    def apply(batch: DataFrame, _: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # At most files_per_trigger.
        if paths:
            store.merge(pages.parsed(paths, landing, name), name, keys, order_by, partition_by, "sync", buckets)

    writer = pages.files.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
