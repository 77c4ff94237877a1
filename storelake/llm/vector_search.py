"""Exact top-k search by vector-approximation files.

Vectors are floored to integers and kept twice: exact, and as blocks of cells. A block is a vector-approximation file
of a bounded number of vectors: each component is replaced by the number of one of a few cells, and each cell
of a block has the least and the largest value in it. The scan reads cells only: with a cell's ends the score of a
query and a vector is bounded on both sides, and a vector whose upper bound is below the k-th best lower bound
can't be among the results. The remaining vectors are read exactly in rounds, by falling upper bound (that is, by
rising lower bound of the distance), until the k-th exact score is above all bounds left.

Scale: the queries are a stated set, dealt out in blocks. A task holds one block of queries and one of cells, and
emits for each query what its own k-th lower bound leaves, so it never emits all pairs of its blocks unless their
bounds cannot tell them apart. Equal vectors are scanned once as queries; as candidates only the first k + 1 of
them by id can be among the k best of a query that is not itself one of these, so the others are left out before
the scan: this loses no result. Every step is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.shared import stored

TOP = 20
UNIT = 64  # Components are floored to multiples of 1 / UNIT.
CELLS = 64  # Cells to a component.
BLOCK = 4096  # Vectors to a block of cells.
QUERY_BLOCK = 512
# Of a pair of blocks: the vectors' rows, cells and ends of cells, the queries' rows and components.
_PAYLOAD = {"rows": "i8", "codes": "u1", "low": "f8", "high": "f8", "queries": "i8", "wanted": "i8"}
_EXACT = 2.0**50  # Products of this size are still exact in doubles, with room for their sums.


# --- vectors ----------------------------------------------------------------------------------


def floored(vectors: DataFrame, unit: int = UNIT) -> DataFrame:
    """(row, vec_id, dims, vec): a number of its own per row, and the components as integers.

    Null vectors and those that hold a null or a value that is no finite number are left out.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(unit * x.cast("double")))
    return vectors.filter(F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.size("embedding").alias("dims"), whole.alias("vec"))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dims)


def _bytes(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def cell_block(vec: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell of each component, and the least and largest value of each cell: arrays (n, dims), (dims, cells) twice.

    Cells hold about equally many vectors; equal values share a cell.
    """
    n, dims = vec.shape
    codes = np.zeros((n, dims), np.uint8)
    low, high = np.zeros((dims, cells)), np.zeros((dims, cells))
    for d in range(dims):
        values, place, counts = np.unique(vec[:, d], return_inverse=True, return_counts=True)
        if len(values) <= cells:
            code = np.arange(len(values))
        else:
            code = np.minimum((np.cumsum(counts) - counts) * cells // n, cells - 1)
        codes[:, d] = code[place]
        first = np.unique(code, return_index=True)[1]
        last = np.append(first[1:], len(values)) - 1
        low[d, code[first]], high[d, code[first]] = values[first], values[last]
    return codes, low, high


def _cell_blocks(cells: int):
    def run(group: pa.Table) -> pa.Table:
        dims = group["dims"][0].as_py()
        codes, low, high = cell_block(_matrix(group["vec"], dims), cells)
        return pa.table({
            "dims": pa.array([dims], pa.int32()), "block": pa.array([group["block"][0].as_py()], pa.int64()),
            "rows": [_bytes(group["row"].to_numpy(), "i8")], "codes": [_bytes(codes, "u1")],
            "low": [_bytes(low, "f8")], "high": [_bytes(high, "f8")]})
    return run


def _query_block(group: pa.Table) -> pa.Table:
    dims = group["dims"][0].as_py()
    return pa.table({
        "dims": pa.array([dims], pa.int32()), "part": pa.array([group["part"][0].as_py()], pa.int64()),
        "queries": [_bytes(group["row"].to_numpy(), "i8")], "wanted": [_bytes(_matrix(group["vec"], dims), "i8")]})


def _dealt(df: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows of each number of dimensions dealt into blocks of about ``size`` rows, and the number of blocks."""
    blocks = df.groupBy("dims").agg(F.ceil(F.count("*") / size).alias(f"{name}s"))
    number = F.pmod(F.xxhash64("row"), F.col(f"{name}s")).alias(name)
    return df.join(blocks, "dims").select("row", "dims", "vec", number), blocks


# --- scan -------------------------------------------------------------------------------------


def bounds(queries: np.ndarray, codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of all queries and vectors, from the ends of the vectors' cells."""
    which = np.arange(codes.shape[1])
    least, most = low[which, codes], high[which, codes]
    wanted = queries.astype(float)
    middle, spread = wanted @ ((least + most) / 2).T, np.abs(wanted) @ ((most - least) / 2).T
    largest = max(np.abs(least).max(initial=0), np.abs(most).max(initial=0))
    reach = np.abs(wanted).sum(axis=1, keepdims=True) * largest
    # Half integers of moderate size add up exactly; beyond that the bounds give way by more than rounding can take.
    slack = np.where(reach < _EXACT, 0, reach * 2.0**-40)
    return middle - spread - slack, middle + spread + slack


def _scan(top: int, cells: int):
    def run(pair: pa.Table) -> pa.Table:
        dims = pair["dims"][0].as_py()
        rows, codes, low, high, asked, wanted = (
            np.frombuffer(pair[name].drop_null()[0].as_py(), kind) for name, kind in _PAYLOAD.items())
        codes, ends = codes.reshape(len(rows), dims), (low.reshape(dims, cells), high.reshape(dims, cells))
        lower, upper = bounds(wanted.reshape(len(asked), dims), codes, *ends)
        if len(rows) > top:
            worst = np.partition(lower, len(rows) - top, axis=1)[:, len(rows) - top]
        else:
            worst = np.full(len(asked), -np.inf)
        q, v = np.nonzero(upper >= worst[:, None])
        return pa.table({"query": asked[q], "row": rows[v], "lower": lower[q, v], "upper": upper[q, v]})
    return run


def candidates(queries: DataFrame, vectors: DataFrame, top: int, cells: int = CELLS, block: int = BLOCK,
               query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query, row, upper) for all pairs that the cells leave in doubt, of frames (row, dims, vec)."""
    held, blocks = _dealt(vectors, block, "block")
    file = stored(held.groupBy("dims", "block").applyInArrow(
        _cell_blocks(cells), "dims int, block long, rows binary, codes binary, low binary, high binary"), "cells")
    asked, asked_parts = _dealt(queries, query_block, "part")
    parts = stored(asked.groupBy("dims", "part").applyInArrow(
        _query_block, "dims int, part long, queries binary, wanted binary"), "queries")
    # A pair of blocks is a group of two rows: either side goes to each block of the other.
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    pairs = parts.join(blocks, "dims").withColumn("block", every("blocks")).unionByName(
        file.join(asked_parts, "dims").withColumn("part", every("parts")), allowMissingColumns=True)
    found = stored(pairs.groupBy("dims", "block", "part").applyInArrow(
        _scan(top, cells), "query long, row long, lower double, upper double"), "scanned")
    best = Window.partitionBy("query").orderBy(F.col("lower").desc(), "row")
    worst = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top).groupBy("query").agg(
        F.when(F.count("*") == top, F.min("lower")).otherwise(float("-inf")).alias("worst"))
    return found.join(worst, "query").filter(F.col("upper") >= F.col("worst")).select("query", "row", "upper")


# --- exact reading ----------------------------------------------------------------------------


def _score(a: Column, b: Column) -> Column:
    """Inner product in 64-bit integers; one that leaves them is cut to their end."""
    exact = F.aggregate(F.zip_with(a, b, F.try_multiply), F.lit(0).cast("bigint"), F.try_add)
    near = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    return F.coalesce(exact, F.when(near > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-(1 << 63))))


def nearest(queries: DataFrame, vectors: DataFrame, top: int, cells: int = CELLS, block: int = BLOCK,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query, row, vec_id, score): the best ``top`` vectors of each query, ties to the smaller vec_id, then row."""
    doubtful = candidates(queries, vectors, top, cells, block, query_block)
    order = Window.partitionBy("query").orderBy(F.col("upper").desc(), "row")
    waiting = stored(doubtful.withColumn("place", F.row_number().over(order)), "doubtful")
    best, last, until = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row"), 0, 2 * top
    found = None
    while True:
        read = waiting.filter(F.col("place").between(last + 1, until))
        exact = read.join(queries.select(F.col("row").alias("query"), F.col("vec").alias("wanted")), "query").join(
            vectors.select("row", "vec_id", "vec"), "row").select(
                "query", "row", "vec_id", _score(F.col("wanted"), F.col("vec")).alias("score"))
        exact = exact if found is None else found.unionByName(exact)
        found = stored(exact.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top).drop("place"), "nearest")
        worst = found.groupBy("query").agg(F.min("score").alias("worst"))
        # A query with fewer than ``top`` results so far has no more candidates: the first round reads twice as many.
        left = stored(waiting.filter(F.col("place") > until).join(worst, "query").filter(F.col("upper") >= F.col("worst")).select(
            "query", "row", "upper", "place"), "left")
        if left.isEmpty():
            return found
        waiting, last, until = left, until, 8 * until


def top_vectors(vectors: DataFrame, top: int = TOP, asked: Column | None = None, cells: int = CELLS, block: int = BLOCK,
                query_block: int = QUERY_BLOCK, unit: int = UNIT) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``top`` other rows of the largest integer inner product.

    ``asked`` says which rows are queries, those whose vec_id is divisible by 20 by default. Null vectors and
    vectors with null or non-finite components take no part; vectors are compared with those of as many
    components only, and all score 0 where there are none. A row is no candidate of itself, but a repeated
    row is one of its copies. Ties go to the smaller vec_id, rows without one last. A query with fewer
    candidates has all of them; one without any has no row. Scores beyond 64 bits are cut to their ends.
    An empty table gives no rows; other columns are not read.
    """
    asked = F.col("vec_id") % 20 == 0 if asked is None else asked
    every = stored(floored(vectors.select("vec_id", "embedding"), unit), "vectors")
    # A query needs top others: of equal vectors the first top + 1 by id, in case it is among them.
    same = Window.partitionBy("dims", "vec").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    first = stored(every.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= top + 1).drop("place"), "first")
    wanted = every.filter(F.coalesce(asked, F.lit(False)))
    kinds = stored(wanted.groupBy("dims", "vec").agg(F.min("row").alias("row")), "kinds")
    found = nearest(kinds, first, top + 1, cells, block, query_block)
    each = wanted.select(F.col("row").alias("own"), F.col("vec_id").alias("query_id"), "dims", "vec").join(
        kinds.withColumnRenamed("row", "query"), ["dims", "vec"]).select("own", "query_id", "query")
    others = stored(each, "asked").join(found, "query").filter("own <> row")
    place = F.row_number().over(Window.partitionBy("own").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row"))
    return others.withColumn("rank", place).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
