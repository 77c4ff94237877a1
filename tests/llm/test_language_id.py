import math
import os
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from storelake.llm import language_id as li
from storelake.llm.shared import ship_package
from tests.llm.tables import DOCS, by_id, clashing, documents

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_learns_from_the_training_part_only(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = by_id(li.languages(docs))
    rows = docs.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= got[r.doc_id].score <= 1
    held = [r for r in rows if got[r.doc_id].held_out and r.lang]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    hidden = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'zz', lang) AS lang")
    assert {k: v.lang_pred for k, v in by_id(li.languages(hidden)).items()} == {k: v.lang_pred for k, v in got.items()}


def test_score_equals_a_plain_computation(spark):
    ship_package(spark)
    rows = [(1, "aaa bab aab", "a"), (2, "ab aa", "a"), (3, "zzy zyz yzz", "z"), (4, "yz zy 12 z", "z"), (8, "xx aa", "z")]
    model = li.train(documents(spark, rows), smoothing=0.1)
    grams = {lang: Counter() for lang in ("a", "z")}
    for _, text, lang in rows:
        for g in li._grams(text):
            grams[lang].update(g.tolist())
    text = "aab zz!"
    own = Counter(b for g in li._grams(text) for b in g.tolist())
    logs = {}
    for lang, prior in (("a", 2 / 5), ("z", 3 / 5)):
        total = sum(grams[lang].values()) + 0.1 * li.BUCKETS
        logs[lang] = math.log(prior) + sum(n * math.log((grams[lang][b] + 0.1) / total) for b, n in own.items())
    best = max(logs, key=logs.get)
    score = model.score(pd.Series([text]))
    assert score.lang_pred[0] == best
    assert abs(score.score[0] - 1 / sum(math.exp(v - logs[best]) for v in logs.values())) < 1e-9


def test_no_language_vanishes_beside_a_larger_one():
    for n in (10**5, 10**11, 10**15):
        found = li.shares({"big": n, "mid": n // 10, "few": 5}, 20_000)
        assert found["few"] == 1.0 and all(share * li._HASHES >= 1 for share in found.values())
        assert abs(5 + n * found["big"] + n // 10 * found["mid"] - 20_000) < 1
    assert li.shares({"a": 3, "b": 4}, 20_000) == {"a": 1.0, "b": 1.0}


def test_a_rare_language_is_learned_and_many_languages_do_no_harm(spark):
    ship_package(spark)
    rows = [(i, "the of and house", "en") for i in range(3000)] + [(5000 + i, "zyx wvu", "rare") for i in range(5)]
    model = li.train(documents(spark, rows), train_docs=100)
    assert model.languages == ["en", "rare"] and model.score(pd.Series(["zyx wvu wvu"])).lang_pred[0] == "rare"
    assert np.allclose(np.exp(model.prior), [3000 / 3005, 5 / 3005])
    many = [(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26)}", f"l{i % 300:03}") for i in range(600)] + [(900, "same", "l299")]
    learned = li.train(documents(spark, many)).languages
    assert len(learned) == li.MAX_LANGUAGES and "l299" in learned and "l298" not in learned


def test_pieces_of_long_texts_lose_nothing(monkeypatch):
    text = "Straße année niño 12 xİy " * 300
    whole = np.concatenate(list(li._grams(text)))
    monkeypatch.setattr(li, "_CELLS", 64)
    assert Counter(np.concatenate(list(li._grams(text))).tolist()) == Counter(whole.tolist())


def test_awkward_rows(spark):
    ship_package(spark)
    rows = [(1, "der die das", "de"), (2, "the of and", "en"), (3, "the on in", "en"), (4, None, "en"), (6, "", None),
            (7, "123 $$$", None), (None, "der die", None), (8, "the " * 50000, None), (8, "the " * 50000, None), (9, "the", None)]
    got = li.languages(clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert found[4] == found[6] == found[7] == ("und", 0.0)
    assert found[None][0] == "de" and found[8][0] == "en"
    assert li.languages(spark.createDataFrame([], DOCS)).collect() == []
    assert {r.lang_pred for r in li.languages(documents(spark, [(1, "abc"), (2, "x")])).collect()} == {"und"}


def test_undetermined_documents_go(spark):
    ship_package(spark)
    docs = clashing(documents(spark, [(1, "der die das und", "de"), (2, "the of and", "en"), (3, None, "en"), (6, "..", None)]))
    kept = li.keep_identified(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
