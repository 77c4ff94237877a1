import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from storelake.llm import sharding as sh
from storelake.llm.shared import ship_package
from tests.llm.tables import DOCS, clashing, documents


def check(got, rows, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_rows_with_a_hot_group(spark):
    ship_package(spark)
    rows = [(i, "the same text") for i in range(500)] + [(1000 + i, f"é {i}") for i in range(900)]
    rows += [(1, None), (2, ""), (None, "x"), (None, None), (77, "twice"), (77, "twice"), (5, "long " * 100_000)]
    check(sh.shard_rows(clashing(documents(spark, rows)), 24).collect(), rows, 24)


def test_crowded_cells_are_cut(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(sh, "LEAST_CELL", 10)
    monkeypatch.setattr(sh, "CELLS", 64)
    rows = [(i, "same") for i in range(700)] + [(2000 + i, f"t{i}") for i in range(300)]
    check(sh.shard_rows(documents(spark, rows), 7).collect(), rows, 7)


def test_few_and_no_rows(spark):
    ship_package(spark)
    rows = [(1, "a"), (2, "b"), (3, "c")]
    check(sh.shard_rows(documents(spark, rows), 24).collect(), rows, 24)
    assert sh.shard_rows(spark.createDataFrame([], DOCS)).collect() == []


def test_dealing_follows_the_ring():
    """Against the plain form: one row at a time, each round all rows at their nodes, in ring order."""
    pick = random.Random(5)
    for _ in range(20):
        shards, cells = 5, 64
        nodes = sh.ring_nodes(shards, 4, cells)
        counts = np.array([pick.randrange(30) * (pick.random() < 0.4) for _ in range(cells)])
        limits = sh.bounds(int(counts.sum()), shards)
        got = sh.deal(np.arange(cells), counts, nodes, limits)
        taken, homes = Counter(), {c: next((i for i, (at, _) in enumerate(nodes) if at >= c), 0) for c in range(cells)}
        for entry, first, end, shard, _ in got:
            taken[shard] += end - first
        assert [taken[s] for s in range(shards)] == limits
        covered = sorted((e, a, b) for e, a, b, _, _ in got)
        for cell in range(cells):
            own = [(a, b) for e, a, b in covered if e == cell]
            assert [x for ab in own for x in range(*ab)] == list(range(counts[cell]))
        # A shard that is not full by its own rows keeps them all.
        home_load = Counter()
        for cell in range(cells):
            home_load[nodes[homes[cell]][1]] += int(counts[cell])
        kept = Counter()
        for entry, first, end, shard, _ in got:
            if nodes[homes[entry]][1] == shard:
                kept[shard] += end - first
        assert all(kept[s] >= min(home_load[s], limits[s]) for s in range(shards))


def plain_deal(counts, nodes, limits):
    """Row by row: all rows at a node enter its shard in ring order while it has room, the others walk on to the next open node."""
    room, owner, slots = list(limits), {}, Counter()
    waiting = {i: [] for i in range(len(nodes))}
    for entry, n in enumerate(counts):
        home = next((i for i, (at, _) in enumerate(nodes) if at >= entry), 0)
        waiting[home] += [(entry, rank) for rank in range(n)]
    while any(waiting.values()):
        left = {}
        for i in range(len(nodes)):
            for row in waiting[i]:
                shard = nodes[i][1]
                if room[shard]:
                    room[shard] -= 1
                    owner[row] = (shard, slots[shard])
                    slots[shard] += 1
                else:
                    left.setdefault(i, []).append(row)
        waiting = {i: [] for i in range(len(nodes))}
        turn = []
        for i, queue in left.items():
            steps = next(k for k in range(1, len(nodes) + 1) if room[nodes[(i + k) % len(nodes)][1]])
            turn.append((i, (i + steps) % len(nodes), queue))
        for _, goal, queue in sorted(turn):
            waiting[goal] += queue
    return owner


def test_dealing_equals_the_plain_form():
    pick = random.Random(8)
    for _ in range(40):
        shards, cells = pick.randrange(1, 7), 48
        nodes = sh.ring_nodes(shards, 3, cells)
        counts = [pick.choice((0, 0, 1, 5, 40)) for _ in range(cells)]
        limits = sh.bounds(sum(counts), shards)
        got = {(e, rank): (s, slot + rank - first) for e, first, end, s, slot in sh.deal(np.arange(cells), np.array(counts), nodes, limits)
               for rank in range(first, end)}
        assert got == plain_deal(counts, nodes, limits)


def test_rows_that_cannot_be_told_apart_are_spread(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(sh, "LEAST_CELL", 20)
    rows = [(None, "same")] * 900 + [(7, "same")] * 700 + [(i, f"t{i}") for i in range(100, 300)]
    got = sh.shard_rows(documents(spark, rows), 5)
    check(got.collect(), rows, 5)


def test_shards_come_with_their_documents(spark):
    ship_package(spark)
    rows = [(i, f"text {i % 40}", "en", f"s{i % 3}") for i in range(300)] + [(None, None), (5, "twice"), (5, "twice")]
    docs = clashing(documents(spark, rows))
    got = sh.sharded_documents(docs, 7)
    assert got.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert set(got.columns) == {*docs.columns, *got.columns[:7]}
    check(got.collect(), [r[:2] for r in rows], 7)
    assert Counter((r.doc_id, r.text, r.source) for r in got.collect()) == Counter((r[0], r[1], (*r, None, None)[3]) for r in rows)
    assert sh.sharded_documents(spark.createDataFrame([], DOCS)).collect() == []


def test_one_more_shard_moves_few_nodes():
    before, after = sh.ring_nodes(24, 16, sh.CELLS), sh.ring_nodes(25, 16, sh.CELLS)
    assert set(before) <= set(after) and len(after) - len(before) == 16
