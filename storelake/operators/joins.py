"""Join helpers for keys that repeat unevenly.

Sides are never marked for broadcast by hand. The optimizer broadcasts a side when its size, from
file statistics or measured at run time, is below ``spark.sql.autoBroadcastJoinThreshold``; past that
the join shuffles and adaptive execution splits partitions that hold a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = 1024


def left_join_optional(left: DataFrame, right: DataFrame, key: str, row_key: str) -> DataFrame:
    """Left join on a reference that is often NULL.

    NULLs match nothing, but they all hash to one partition when the join shuffles. A second key
    column spreads them by ``row_key``; rows with a reference keep 0 and find their match. On the
    right the 0 is computed from the key, since the optimizer drops a constant from the join keys.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(row_key), F.lit(_SPREAD))).otherwise(F.lit(0))
    keyed = left.withColumn("_spread", spread.cast("bigint"))
    zero = F.pmod(F.col(key), F.lit(1)).cast("bigint")
    return keyed.join(right.withColumn("_spread", zero), [key, "_spread"], "left").drop("_spread")


def expected_small(side: DataFrame) -> bool:
    """Whether the optimizer's own estimate lets it broadcast a side."""
    limit = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def left_join_found(left: DataFrame, found: DataFrame, keys: Sequence[str], row_key: str) -> DataFrame:
    """Left join with what was found for the combinations of ``keys`` that occur; a NULL equals a NULL.

    Rows without any of the keys match nothing and are spread by ``row_key``, as in ``left_join_optional``.
    """
    known = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys])
    spread = F.when(~known, F.pmod(F.xxhash64(row_key), F.lit(_SPREAD))).otherwise(F.lit(0)).cast("bigint")
    keyed = left.withColumn("_spread", spread)
    named = found.filter(known).withColumnsRenamed({k: f"_{k}" for k in keys})
    right = named.withColumn("_zero", F.pmod(F.xxhash64(*[f"_{k}" for k in keys]), F.lit(1)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("_spread") == F.col("_zero"))
    return keyed.join(right, same, "left").drop("_spread", "_zero", *[f"_{k}" for k in keys])
