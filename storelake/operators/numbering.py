"""Numbering all rows of an order in one distributed pass.

A window without a partition brings all rows to one task. Here rows are dealt by range of the order, each
partition counts its own, and only the counts, a row per partition and group, are added up: they are the offsets
of the partitions. The sorted rows are written first, so that a repeated task numbers the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.sources.tables import shared_root

_AT, _PART = "_at", "_part"


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder."""
    path = f"{shared_root(df.sparkSession)}/sorted/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: Sequence[Column], name: str = "row_number", within: Sequence[str] = (),
             keep: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """``df`` with a bigint column of row numbers from 1, in the given order, for each value of ``within``.

    Rows that the order leaves equal are numbered in any order, and all meet in one task, so let the order end
    with a key. NULLs stand where the order puts them; a NULL in ``within`` is a value of its own. ``keep``
    writes the sorted rows. An empty frame stays empty.
    """
    groups = [F.col(c) for c in within]
    ranged = df.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
    placed = keep(ranged.withColumn(_AT, F.monotonically_increasing_id()))
    # The upper bits of the id are the partition, the lower ones the place in it.
    placed = placed.withColumn(_PART, F.shiftright(_AT, 33))
    counts = placed.groupBy(*within, _PART).agg(F.count("*").alias("_n"), F.min(_AT).alias("_first"))
    earlier = Window.partitionBy(*within).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_{c}") for c in within], F.col(_PART).alias("_of"), "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = F.col(_PART) == F.col("_of")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    number = F.col("_before") + F.col(_AT) - F.col("_first") + 1
    return placed.join(offsets, same).select(*df.columns, number.alias(name))
