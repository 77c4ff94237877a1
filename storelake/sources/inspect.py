"""What is stored, how much, and how fresh."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def table_summary(tables: Mapping[str, DataFrame], sample: int = 3) -> DataFrame:
    """Fields and records per table, and its first rows as JSON texts, in the order of its columns from the first on.

    A stored table is counted from its file footers. The sample is a top-k: the first column alone shows how far
    it can reach, and the others are computed and compared for the rows up to there. Counts and samples meet in one
    aggregate, and the reach is the only subquery of a table: Spark runs subqueries on a bounded set of threads (16), and
    as many that wait for inner ones leave none to run these.
    """
    def parts(position: int, name: str, df: DataFrame) -> list[DataFrame]:
        columns = [F.col(f"`{c}`") for c in df.columns]
        about = [F.lit(position).alias("position"), F.lit(name).alias("table_name"), F.lit(len(columns)).alias("fields")]
        reach = df.select(columns[0].alias("v")).orderBy("v").limit(sample).agg(F.max("v")).scalar()
        # NULLs come first; with NULLs only, the reach is NULL.
        first = df.filter(columns[0].isNull() | (columns[0] <= reach)).orderBy(*columns).limit(sample)
        return [df.agg(F.count(F.lit(1)).alias("records")).select(*about, "records", F.lit(None).cast("string").alias("text")),
                first.select(*about, F.lit(0).cast("bigint"), F.to_json(F.struct(*columns)))]

    found = _union([part for i, (name, df) in enumerate(tables.items()) for part in parts(i, name, df)])
    # A row for each table, in the order given.
    return found.groupBy("position", "table_name", "fields").agg(
        F.max("records").alias("records"), F.sort_array(F.collect_list("text")).alias("sample"),
    ).coalesce(1).sortWithinPartitions("position").drop("position")


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(layer).alias("layer"), "records")
                   for layer, df in layers.items()])


def freshness(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest value of one time column per table, as text so that dates and times line up."""
    return _union([df.agg(F.max(column).cast("string").alias("latest")).select(F.lit(name).alias("source"), "latest")
                   for name, (df, column) in tables.items()])


def describe_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


def preview(df: DataFrame, rows: int = 5, by: str | None = None) -> DataFrame:
    """A few rows; the first ones by a column when they must be the same every time."""
    return (df.orderBy(by) if by else df).limit(rows)
