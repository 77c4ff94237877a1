import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from storelake.llm import mixing as mx
from storelake.llm.shared import ship_package
from tests.llm.tables import DOCS, by_id, clashing, documents, prose


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w)


def test_tokens_are_words(spark):
    texts = [None, "", " \t", "a", " a  b\nc\x0b", "x y"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(mx.tokens(F.col("text"))).collect()
    assert [r[0] for r in got] == [len((t or "").encode().split()) for t in texts]


@pytest.mark.parametrize("mix", [mx.Mix(0.9, 100.0), mx.Mix(0.999, 1.5), mx.Mix(0.1, 2.0), mx.Mix(1.0, 1e9), mx.Mix(0.99, 1.0)])
def test_exponent_meets_target_or_limit(spark, mix):
    sizes = {"a": 6000, "b": 1500, "c": 700, "d": 650}
    docs = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, tokens long")
    table, exponent = mx.weights(docs, mix, F.col("tokens"))
    rows = {r.source: r for r in table.collect()}
    weights = {s: n**exponent for s, n in sizes.items()}
    total = sum(weights.values())
    for s, n in sizes.items():
        assert abs(rows[s].weight - weights[s] / total) < 1e-6
        assert rows[s].budget >= n and rows[s].passes <= mix.repetition + 1e-6
    reached = entropy([w / total for w in weights.values()]) >= mix.entropy * math.log(4) - 1e-6
    limited = max(r.passes for r in rows.values()) >= mix.repetition - 1e-6
    assert reached or limited


def mixed_rows(docs, mix):
    return mx.mix_plan(docs, mix).collect()


def test_budgets_are_spent_in_permuted_blocks(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(mx, "BLOCKS", 8)
    rows = [(i, prose(i, 20 + i % 7), None, "big" if i % 10 < 7 else "mid" if i % 10 < 9 else "small") for i in range(400)]
    docs = documents(spark, rows)
    mix = mx.Mix(0.98, 2.6)
    got = mixed_rows(docs, mix)
    size = {r[0]: len(r[1].split()) for r in rows}
    source = {r[0]: r[3] for r in rows}
    total, spent, copies = Counter(), Counter(), Counter(r.doc_id for r in got)
    for i in size:
        total[source[i]] += size[i]
    for r in got:
        spent[r.source] += size[r.doc_id]
    table = {r.source: r for r in mx.weights(docs, mix)[0].collect()}
    for s in total:
        assert 0 <= table[s].budget - spent[s] < max(size.values())
        whole = table[s].budget // total[s]
        assert {copies[i] for i in size if source[i] == s} <= {whole, whole + 1}
        # The last pass is the beginning of its permutation.
        last = {(r.block_order, r.row_order): r.doc_id for r in got if r.source == s and r.epoch == whole}
        cost, order = 0, sorted(last)
        assert sum(size[last[k]] for k in order) <= table[s].budget % total[s]
    assert spent["big"] == total["big"] and set(copies) == set(size)
    shares = {s: spent[s] / sum(spent.values()) for s in total}
    assert all(abs(shares[s] - table[s].weight) < 0.01 for s in total)
    # Each epoch has an order of its own.
    orders = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.block_order, r.row_order)):
        if r.source == "small":
            orders[r.epoch].append(r.doc_id)
    assert orders[0] != orders[1] and sorted(orders[0]) == sorted(orders[1])


def test_awkward_rows(spark):
    ship_package(spark)
    rows = [(1, "a b c", None, "s"), (2, None, None, "s"), (3, "", None, "empty"), (4, None, None, "empty"), (5, "x " * 30000, None, "t"),
            (None, "one two", None, None), (6, "three", None, None), (7, "same", None, "s"), (7, "same", None, "s")]
    docs = clashing(documents(spark, rows))
    got = mx.mixed(docs)
    assert got.columns == [*[c for c in docs.columns if c != "mix_epoch"], "mix_epoch", "mix_weight", "mix_block", "mix_row"]
    first = [r for r in got.collect() if r.mix_epoch == 0]
    assert Counter((r.doc_id, r.text) for r in first) == Counter((r[0], r[1]) for r in rows)
    assert by_id(got)[3].mix_weight == 0 and by_id(got)[5].mix_weight > by_id(got)[1].mix_weight > 0
    assert mx.mixed_documents(docs).columns == docs.columns
    assert mixed_rows(spark.createDataFrame([], DOCS), mx.Mix()) == []
    assert len(mixed_rows(documents(spark, [(1, None, None, "a"), (2, "", None, None)]), mx.Mix())) == 2
    assert len(mixed_rows(documents(spark, [(1, "a b", None, "a"), (2, "c", None, "a")]), mx.Mix())) == 2


def test_equal_sources_are_taken_once(spark):
    ship_package(spark)
    rows = [(i, "w " * 5, None, f"s{i % 3}") for i in range(30)]
    assert len(mixed_rows(documents(spark, rows), mx.Mix())) == 30
