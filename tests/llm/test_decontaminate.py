import random
import time

import pytest

from storelake.llm import decontaminate as dc
from storelake.llm.queries import QUERIES
from storelake.llm.shared import ship_package
from tests.llm.tables import DOCS, by_id, clashing, documents, prose
from tests.llm.test_pipeline import pipeline_module


def plain_search(item, text):
    """Least edits of an occurrence of item in text, and its first end, by the full table."""
    row = list(range(len(item) + 1))
    best = (row[-1], 0)
    for j, c in enumerate(text, 1):
        new = [0]
        for i, d in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != d)))
        row = new
        best = min(best, (row[-1], j), key=lambda b: b[0])
    return best


def test_myers_equals_the_full_table():
    pick = random.Random(4)
    for _ in range(300):
        item = "".join(pick.choice("abc ") for _ in range(pick.randrange(1, 90)))
        text = "".join(pick.choice("abc ") for _ in range(pick.randrange(60))) + item[3:] + "ab"
        best = plain_search(item, text)
        budget = pick.randrange(6)
        got = dc.myers(item, text, budget)
        assert (got[0] if got else None) == (best[0] if best[0] <= budget and best[1] else None) or best[1] == 0
        if got and best[1]:
            assert got == best


def edited(text, edits, pick):
    chars = list(text)
    for _ in range(edits):
        at = pick.randrange(len(chars))
        kind = pick.randrange(3)
        if kind == 0:
            chars[at] = "#"
        elif kind == 1:
            chars.insert(at, "#")
        else:
            del chars[at]
    return "".join(chars)


def test_every_occurrence_within_budget_is_found():
    pick = random.Random(6)
    items = [(i, dc.normalised(prose(100 + i, 30))) for i in range(20)]
    matcher = dc.Matcher(items, 0.05)
    for trial in range(60):
        number, item = pick.choice(items)
        budget = int(len(item) * 0.05)
        text = dc.normalised(prose(trial, 40) + " " + edited(item, pick.randrange(budget + 1), pick) + " " + prose(trial + 1, 40))
        hits = [h for h in matcher.find(text) if h[0] == number]
        assert hits and plain_search(item, text)[0] == min(h[3] for h in hits)
        for _, start, end, edits in hits:
            assert plain_search(item, text[start:end])[0] == edits
    clean = [dc.normalised(prose(500 + i, 300)) for i in range(50)]
    assert not any(matcher.find(t) for t in clean)


def test_thousands_of_copies_are_all_found_in_one_scan():
    item = dc.normalised(prose(1, 20))
    pick = random.Random(5)
    for copies, glue in ((3000, " "), (3000, ""), (500, " and ")):
        parts = [edited(item, i % 3, pick) for i in range(copies)]
        text = dc.normalised(glue.join(parts))
        began = time.process_time()
        hits = dc.Matcher([(1, item)], 0.05).find(text)
        assert time.process_time() - began < 20
        assert len(hits) == copies and all(a[2] <= b[1] for a, b in zip(hits, hits[1:]))
        assert sum(h[3] for h in hits) <= sum(i % 3 for i in range(copies))
    periodic = "abc " * 10
    hits = dc.Matcher([(1, periodic.strip())], 0.05).find(dc.normalised(periodic * 200))
    assert 190 <= len(hits) <= 201 and min(h[3] for h in hits) == 0


@pytest.mark.parametrize("block_chars", [1 << 20, 100])
def test_rows(spark, block_chars):
    ship_package(spark)
    a, b = prose(1, 25), prose(2, 40)
    bench = spark.createDataFrame([(1, a), (2, b), (2, b), (3, None), (4, "short"), (5, ""), (1, prose(9, 30)), (None, prose(8, 30))],
                                  "item_id long, text string")
    long = prose(3, 40000)
    rows = [(1, f"x {a.upper()} y"), (2, long + "\n" + b.replace(" ", " \t ") + "\n" + a), (3, None), (4, ""), (5, prose(4, 300)),
            (None, b), (1, f"x {a.upper()} y"), (6, f"{a} and {a}"), (7, "short"), (8, b[:len(b) // 2])]
    docs = clashing(documents(spark, rows))
    got = dc.contamination(docs, bench, block_chars=block_chars, short=False).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r for r in got}
    assert found[1].items == "1" and found[1].spans == f"1:2:{2 + len(a)}:0"
    assert found[2].items == "1,2" and found[2].n_items == 2
    assert found[None].items == "2" and found[6].n_items == 1 and found[6].spans.count(",") == 1
    assert [d for d in (3, 4, 5, 7, 8) if found[d].contaminated] == []
    assert {r.doc_id for r in dc.contamination(docs, bench, block_chars=block_chars).collect() if r.contaminated} == {1, 2, None, 6, 7}
    kept = dc.keep_uncontaminated(docs, bench, short=False)
    assert kept.columns == docs.columns and sorted(by_id(kept)) == [3, 4, 5, 7, 8]
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in dc.contamination(docs, none).collect())
    assert dc.contamination(spark.createDataFrame([], DOCS), bench).collect() == []


def test_short_items_are_found_word_for_word(spark, tmp_path):
    """By the registered query and by the stage of the pipeline; plain speech around them stays."""
    items = [(1, "Who wrote  Hamlet?"), (2, "水の沸点は何度ですか"), (3, "2 + 2 ="), (4, "हिन्द"), (5, " "), (6, "=>"),
             (7, "a b a"), (8, prose(1, 25))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "who wrote hamlet?"), (2, "Quiz:\nWho wrote Hamlet? Shakespeare"), (3, "問題、水の沸点は何度ですか。百度"),
            (4, "so 2 + 2 = 4"), (5, "a b a b a"), (6, f"x {prose(1, 25)}"), (7, "x => y"), (8, "(हिन्द)"),
            (11, "nowho wrote hamlet?"), (12, "who wrote hamlets?"), (13, "12 + 2 = 14"), (14, "हिन्दी"), (15, "a==>b"), (16, "a b ab"),
            (17, "who wrote a hamlet?"), (18, "水の沸点"), (19, " "), (20, None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = by_id(QUERIES["op7_decontaminate"](spark, str(tmp_path)))
    assert {d: r["items"] for d, r in found.items() if r["contaminated"]} == {
        1: "1", 2: "1", 3: "2", 4: "3", 5: "7", 6: "8", 7: "6", 8: "4"}
    assert found[1]["spans"] == "1:0:17:0" and found[5]["spans"] == "7:0:5:0,7:4:9:0"
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = by_id(dict(pipeline_module().STAGES)["benchmark_decontamination"](spark, docs, str(tmp_path)))
    assert sorted(kept) == [11, 12, 13, 14, 15, 16, 17, 18, 19, 20]
