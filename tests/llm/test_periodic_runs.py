import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from storelake.llm import periodic_runs as op
from storelake.llm.queries import QUERIES
from storelake.llm.shared import read_table, ship_package, word_pieces
from tests.llm.tables import DOCS, by_id, clashing, documents, prose


def plain_runs(words, repeats=4, least=6):
    """Every period, every stretch of words that equal the word one period on, and no smaller period."""
    found, n = {}, len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, repeats * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def planted(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain_row(doc_id, text):
    words = planted(doc_id, text)
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(plain_collapse(words, runs))))


@pytest.mark.parametrize("repeats", [3, 4])
def test_runs_equal_brute_force_on_random_words(repeats):
    pick = random.Random(repeats)
    for _ in range(400):
        texts = []
        for _ in range(pick.randrange(1, 4)):
            words = [pick.choice("abc"[:pick.randrange(1, 4)]) for _ in range(pick.randrange(30))]
            unit = [pick.choice("abcd") for _ in range(pick.randrange(1, 9))]
            texts.append(" ".join(words + unit * pick.randrange(8) + unit[:pick.randrange(9)] + words[:5]).encode())
        codes, ends = op.word_codes(texts)
        got = op.runs_of(codes, ends, repeats)
        want = [(s + ends[i], n, q) for i, t in enumerate(texts) for s, n, q in plain_runs(t.split(), repeats)]
        assert [tuple(r) for r in got.tolist()] == want


def test_fewer_than_three_repeats_are_refused():
    with pytest.raises(ValueError):
        op.runs_of(np.zeros(4, np.int64), np.array([0, 4]), 2)


def test_pieces_hold_every_word_once():
    text = (" a\tbb\n" * 50 + "c" * 300 + "\x0b \x0cd e").encode()
    assert [w for piece in word_pieces(text, 64) for w in piece] == text.split()


def test_query_equals_brute_force(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").filter("length(text) < 6000")
    ship_package(spark)
    got = op.run_digests(op.periodic_runs(op.with_planted_repeats(docs)))
    assert sorted(map(tuple, got.collect())) == sorted(plain_row(r["doc_id"], r["text"]) for r in docs.collect())
    assert QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001").count() == 200


def test_awkward_rows(spark):
    ship_package(spark)
    rows = [(10, None), (11, ""), (12, " \t\n"), (13, "a " * 6), (13, "a " * 6), (14, "a b " * 4 + "c"), (15, "x " * 50_000),
            (16, prose(1, 300) + " " + "la la la di " * 9), (17, "a\xa0b " * 7), (18, "é É " * 3), (None, "z " * 9)]
    rows += [(i, f"w{i} " * 8) for i in range(100, 160)]
    found = by_id(op.periodic_runs(clashing(documents(spark, rows))))
    assert [list(found[i]["runs"]) for i in (10, 11, 12)] == [[], [], []]
    assert found[13]["runs"] == [(0, 6, 1)] and found[13]["collapsed"] == "a"
    assert found[14]["runs"] == [(0, 8, 2)] and found[14]["collapsed"] == "a b c"
    assert found[15]["runs"] == [(0, 50_000, 1)] and found[15]["n_words"] == 50_000
    assert found[16]["runs"] == plain_runs((rows[7][1]).split())
    assert found[17]["runs"] == [(0, 7, 1)] and found[18]["runs"] == []
    assert found[None]["collapsed"] == "z"
    digests = op.run_digests(op.periodic_runs(op.with_planted_repeats(clashing(documents(spark, rows)))))
    want = [plain_row(*r) for r in rows if r[0] not in (None, 15)]
    assert sorted(tuple(r) for r in digests.collect() if r["doc_id"] not in (None, 15)) == sorted(want)
    assert op.periodic_runs(spark.createDataFrame([], DOCS)).collect() == []
