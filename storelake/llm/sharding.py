"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns many points of a ring; a row belongs to the next point clockwise from its own place. A
shard takes no more rows than its bound, and what overflows goes on clockwise to the next points until a
shard has room. With bounds that add up to the number of rows, counts are at most one apart, and only
overflowing rows leave the shard that plain consistent hashing gives them.

A row's place is the hash of its text, then of its doc_id: equal texts are neighbours on the ring and
stay together unless a bound falls within them.

Scale: texts are read once, for their size and checksums. The ring is cut into a fixed number of cells;
crowded cells are cut again by the hash of doc_id, and what is crowded still, rows that repeat text and id or
have no id, by row, so that no cell is large, whatever a group of copies holds. The driver sees the cells'
counts, at most ``5 * CELLS`` numbers, and deals out whole ranges of ranks. Rows are ranked within their cells.
"""

from __future__ import annotations

from bisect import bisect_left
from uuid import uuid4

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.shared import stored

CELLS = 1 << 14
LEAST_CELL = 200  # Rows below which a cell is never cut.
VIRTUAL_NODES = 256


def ring_nodes(shards: int, virtual_nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise. A node's place depends on its own name only."""
    return sorted((xxhash.xxh64_intdigest(f"shard {s} node {v}") * cells >> 64, s)
                  for s in range(shards) for v in range(virtual_nodes))


def bounds(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def deal(cells: np.ndarray, counts: np.ndarray, nodes: list[tuple[int, int]], limits: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of which cell go to which shard: (entry, first, end, shard, first slot).

    ``cells`` and ``counts`` list the parts of the ring in order (a crowded cell has several entries). Round
    by round, all rows that wait at a node enter its shard in ring order as far as there is room; the rest
    go on clockwise to the next node whose shard is not full. The limits add up to the rows, so all find room.
    """
    room, slots = list(limits), [0] * len(limits)
    places = [c for c, _ in nodes]
    waiting: list[list[tuple[int, int, int]]] = [[] for _ in nodes]
    for entry, (cell, count) in enumerate(zip(cells.tolist(), counts.tolist())):
        if count:
            waiting[bisect_left(places, cell) % len(nodes)].append((entry, 0, count))
    out = []
    while any(waiting):
        left: dict[int, list[tuple[int, int, int]]] = {}
        for at, queue in enumerate(waiting):
            shard = nodes[at][1]
            for entry, first, end in queue:
                taken = min(room[shard], end - first)
                if taken:
                    out.append((entry, first, first + taken, shard, slots[shard]))
                    room[shard] -= taken
                    slots[shard] += taken
                if first + taken < end:
                    left.setdefault(at, []).append((entry, first + taken, end))
        waiting = [[] for _ in nodes]
        goal = 0
        for at in sorted(left):  # Once around the ring, and on past its start.
            goal = max(goal, at + 1)
            while not room[nodes[goal % len(nodes)][1]]:
                goal += 1
            waiting[goal % len(nodes)] += left[at]
    return out


def shard_rows(docs: DataFrame, shards: int = 24, virtual_nodes: int = VIRTUAL_NODES, row: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs``; the law is ``rows``.

    size is the text's UTF-8 bytes plus 8; a null text has none and the checksum of an empty one. Counts of
    shards differ by one at most, slots run from 0 without gaps, grown_shard is null under this law. Fewer
    rows than shards leave the last shards empty, no rows give no rows. Repeated rows and rows without
    doc_id are dealt like any others; which of them lies where is left open. Very long texts are only hashed. Other
    columns, whatever their names, are not read, but for ``row``: a number of each row's own, which then comes back too.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = stored(docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("place"), F.xxhash64(F.col("doc_id").cast("string"), F.lit("place")).alias("inner"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row")), "sizes")
    cell = F.shiftrightunsigned("place", 64 - (CELLS.bit_length() - 1)).cast("int")
    by_cell = {r["cell"]: r["n"] for r in slim.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}
    total = sum(by_cell.values())
    most = max(LEAST_CELL, -(-2 * total // CELLS))
    # Crowded cells are cut into as many parts as keep each near ``most`` rows: CELLS parts more in all.
    parts = {c: -(-n // most) for c, n in by_cell.items() if n > most}
    spark = docs.sparkSession
    cuts = spark.createDataFrame(list(parts.items()), "cell int, parts int")
    # At most CELLS rows of two numbers.
    cut = slim.withColumn("cell", cell).join(F.broadcast(cuts), "cell", "left")
    part = F.pmod(F.shiftrightunsigned("inner", 1), F.coalesce("parts", F.lit(1))).cast("int")
    placed = cut.withColumn("part", part).drop("parts")
    by_part = placed.groupBy("cell", "part").agg(F.count("*").alias("n"))
    again = by_part.filter(F.col("n") > 4 * most).select("cell", "part", F.ceil(F.col("n") / most).alias("subs"))
    # At most CELLS rows: each stands for more than ``most`` rows.
    placed = placed.join(F.broadcast(again), ["cell", "part"], "left")
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("row"), F.coalesce("subs", F.lit(1))).cast("int")).drop("subs")
    found = sorted(tuple(r) for r in placed.groupBy("cell", "part", "sub").agg(F.count("*").alias("n")).collect())
    cells = np.array([f[0] for f in found], np.int64)
    counts = np.array([f[-1] for f in found], np.int64)
    plan = deal(cells, counts, ring_nodes(shards, virtual_nodes, CELLS), bounds(total, shards))
    schema = "cell int, part int, sub int, first long, end long, shard int, slot_of_first long"
    ranges = spark.createDataFrame([(*found[e][:3], a, b, s, slot) for e, a, b, s, slot in plan], schema)
    dealt = ranges.groupBy("cell", "part", "sub").agg(F.array_sort(F.collect_list(
        F.struct("first", "end", "shard", "slot_of_first"))).alias("ranges"))
    rank = F.row_number().over(Window.partitionBy("cell", "part", "sub").orderBy("place", "inner", "doc_id", "row")) - 1
    ranked = placed.withColumn("rank", rank.cast("long"))
    # As many rows as cells, with a range for each shard that serves one: bounded like the cells.
    joined = ranked.join(F.broadcast(dealt), ["cell", "part", "sub"])
    own = F.element_at(F.filter("ranges", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["end"])), 1)
    return joined.withColumn("own", own).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("own.shard").alias("shard"),
        (F.col("own.slot_of_first") + F.col("rank") - F.col("own.first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *([F.col("row").alias(row)] if row else []))


def sharded_documents(docs: DataFrame, shards: int = 24, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """What ``shard_rows`` says of each row, and the row's other columns: the shards with their documents.

    Rows are dealt without their texts, which then meet shard and slot by a number of the row's own. Null texts,
    repeated rows and rows without doc_id are kept; columns named like those of ``shard_rows`` give way to them.
    """
    row = f"row_{uuid4().hex}"
    held = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    dealt = shard_rows(held.select("doc_id", "text", row), shards, virtual_nodes, row)
    rest = [c for c in docs.columns if c not in dealt.columns]
    return dealt.join(held.select(row, *rest), row).select(*[c for c in dealt.columns if c != row], *rest)
