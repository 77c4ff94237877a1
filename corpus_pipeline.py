"""From documents to shards of training text: each stage calls one operator and hands on the rows it keeps.

In every stage null and empty texts, repeated rows, rows without doc_id and further columns of any name follow the
operator it calls, very long texts are read whole, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storelake.llm.decontaminate import keep_uncontaminated
from storelake.llm.language_id import keep_identified
from storelake.llm.mixing import Mix, mixed_documents
from storelake.llm.sharding import sharded_documents
from storelake.llm.shared import read_table, scratch_path, ship_package
from storelake.llm.simhash_near import keep_one

SHARDS = 24


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language cannot be told go: null or empty text, no letters, or no clear winner. Repeated rows share their fate."""
    ship_package(spark)
    return keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays, of its repeated rows one.

    Texts without words are copies of one another. Rows without doc_id stay.
    """
    ship_package(spark)
    return keep_one(docs, words=4, distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, all rows that repeat one too. Null and empty texts stay, an empty benchmark takes nothing."""
    ship_package(spark)
    return keep_uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources come again, up to twice; none goes. A null source is a source."""
    return mixed_documents(docs, Mix())


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row, with its document. Columns named like those of the shards give way to them."""
    ship_package(spark)
    return sharded_documents(docs, SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None  # A trained classifier, SimHash groups and a ring are beyond SQL.


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        found = stage(spark, docs, sf_dir)
        found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs
