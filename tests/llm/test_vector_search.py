import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelake.llm.shared import ship_package
from storelake.llm.vector_search import bounds, cell_block, floored, top_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, top):
    """Every row against every other one."""
    whole = lambda v: [int(np.floor(64 * float(np.float32(x)))) for x in v]
    known = [(i, r[0], whole(r[1])) for i, r in enumerate(rows)
             if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    out = []
    for i, q, a in known:
        if q is None or q % 20:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), v is None, v or 0, v) for j, v, b in known if i != j and len(a) == len(b)]
        out += [(q, n, s[3], -s[0]) for n, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def awkward():
    pick = random.Random(2)
    vec = lambda n=8: [pick.gauss(0, 0.4) for _ in range(n)]
    rows = [(i, vec(), 0) for i in range(300)]
    rows += [(i, [0.5] * 8, 1) for i in range(300, 480)] + [(i, [pick.choice([0.0, 0.25]) for _ in range(8)], 1) for i in range(480, 700)]
    rows += [(700, None, 0), (720, [None] * 8, 0), (740, [float("nan"), *[0.1] * 7], 0), (760, [float("inf"), *[0.1] * 7], 0),
             (780, [], 0), (800, [], 0), (820, [0.3], 0), (840, vec(3), 0), (860, vec(3), 0), (None, vec(), 0), (None, [0.5] * 8, 0),
             (20, vec(), 0), (20, rows[20][1], 0), (880, [5e4, -5e4, *vec(6)], 0), (900, [1e-9, -1e-9, *vec(6)], 0), (320, [0.5] * 8, 1)]
    return rows


@pytest.mark.parametrize("cells, block, query_block", [(64, 4096, 512), (3, 50, 7)])
def test_equals_brute_force(spark, cells, block, query_block):
    ship_package(spark)
    rows = awkward()
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"1 AS {c}" for c in ("row", "dims", "vec", "query", "score", "block")])
    assert found(top_vectors(table, 5, cells=cells, block=block, query_block=query_block)) == plain(rows, 5)


def test_few_rows_and_none(spark):
    ship_package(spark)
    rows = [(0, [1.0, 2.0], 0), (20, [1.0, 2.0], 0), (3, [0.0, -1.0], 0)]
    assert found(top_vectors(spark.createDataFrame(rows, SCHEMA))) == plain(rows, 20)
    assert top_vectors(spark.createDataFrame(rows[:1], SCHEMA)).collect() == []
    assert top_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_scores_beyond_64_bits_are_cut(spark):
    ship_package(spark)
    rows = [(0, [3e37, 0.0], 0), (1, [3e37, 1.0], 0), (2, [-3e37, 1.0], 0), (3, [0.0, 1.0], 0)]
    got = found(top_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert [r[2:] for r in got] == [(1, 2**63 - 1), (3, 0), (2, -2**63)]


def test_bounds_hold_and_cells_decide_most():
    pick = np.random.default_rng(3)
    for scale in (8, 1e9):
        vec = np.floor(pick.normal(0, scale, (2000, 16))).astype(np.int64)
        queries = vec[:40]
        for cells in (2, 16, 64):
            codes, low, high = cell_block(vec, cells)
            lower, upper = bounds(queries, codes, low, high)
            exact = queries.astype(object) @ vec.T.astype(object)
            assert (lower <= exact).all() and (exact <= upper).all()
    assert ((upper >= np.sort(lower, axis=1)[:, -20:-19]).sum(axis=1) < 200).all()


def test_equal_vectors_are_cut_before_they_are_dealt(spark):
    plan = top_vectors(spark.createDataFrame(awkward(), SCHEMA), 5)  # Runs the search.
    assert plan.columns == ["query_id", "rank", "vec_id", "score"]
    limited = floored(spark.createDataFrame(awkward(), SCHEMA)).withColumn("place", F.expr(
        "row_number() over (partition by dims, vec order by vec_id)")).filter("place <= 6")
    text = limited._jdf.queryExecution().executedPlan().toString()
    assert re.search("WindowGroupLimit.*Partial", text) and re.search("WindowGroupLimit.*Final", text)
