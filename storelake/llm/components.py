"""Connected components of a link table, in rounds of joins and minima (large star, small star).

Every round is a combinable minimum per node and an equi-join back, so a node with very many links is
merged map-side and split by adaptive execution. The links never reach the driver: it sees a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.shared import stored


def _checksum(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    joined = both.filter("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are linked to the least of them. Links go from a down to b."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    rest = links.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return rest.unionByName(least.withColumnRenamed("least", "b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node that can be reached.

    Links with a null end or from a node to itself say nothing and are left out; no links give no rows.
    Nodes without links are not listed: each is its own root.
    """
    down = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = stored(down, "links")
    before = _checksum(current)
    while before[0]:
        current = stored(_small_star(_large_star(current)), "stars")
        after = _checksum(current)
        if after == before:
            break
        before = after
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)
