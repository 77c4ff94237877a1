import base64
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from storelake.llm import secrets as sc
from tests.llm.tables import DOCS, clashing, documents, prose

KEYS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""({KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_spans(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


@pytest.fixture(scope="module")
def ratios(spark):
    docs = documents(spark, [(i, prose(i, 300)) for i in range(30)])
    return sc.train(sc.labelled_samples(spark, docs))


def test_base_spans_equal_the_patterns(spark, ratios):
    pick = random.Random(9)
    bits = ["password", "PassWD", "api_key", "APIKEY", "secret", "token", "=", ":", " ", "'", '"', "abc123", "x", "é", "😀", "\n", "AKIA",
            "AKIA" + "Z9" * 8, "0f" * 12, "0f" * 11, "deadbeef", ".", "ſecret", "K", "hello_world", "-", "AKIAAKIA", "İ"]
    rows = [(i, "".join(pick.choice(bits) for _ in range(pick.randrange(25)))) for i in range(600)]
    rows += [(700, None), (701, ""), (None, "token=abcdef1"), (702, "x" * 300_000), (703, ("password: s3cr3ts! " * 3000)),
             (704, "a=" * 50_000), (705, "0f" * 100_000), (706, "token=abcdef1"), (706, "token=abcdef1")]
    got = sc.secret_digests(clashing(documents(spark, rows)), ratios).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        base = plain_spans(texts[r.doc_id] or "")
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), texts[r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b[1] == k for b in base) for k in range(3))
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == joined.split(",") * bool(joined)
    assert sc.secret_digests(spark.createDataFrame([], DOCS)).collect() == []


def test_models_tell_random_words_from_ordinary_ones(spark, ratios):
    pick = random.Random(2)
    random_words = [base64.b64encode(pick.randbytes(24)).decode() for _ in range(150)]
    random_words += ["".join(pick.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(32)) for _ in range(50)]
    ordinary = ["_".join(prose(i, 4).split()) for i in range(100)] + [prose(i, 4).title().replace(" ", "") for i in range(50)]
    ordinary += [prose(i, 4).upper().replace(" ", "-") for i in range(50)]
    rows = [(i, f"x {w} y") for i, w in enumerate([*random_words, *ordinary])]
    got = {r.doc_id: r.n_random for r in sc.secret_digests(documents(spark, rows), ratios).collect()}
    assert sum(got[i] == 1 for i in range(200)) >= 190
    assert sum(got[i] for i in range(200, 400)) <= 2


def test_ratio_equals_a_plain_sum(spark, ratios):
    words = ["aZ9+/_=-b", "hello", "é?x", "q", ""]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(sc.mean_ratio(F.col("w"), ratios)).collect()
    for word, (value,) in zip(words, got):
        at = [sc.ALPHABET.find(c) + 1 for c in word]
        steps = [ratios[a * len(sc.ALPHABET) + a + b] for a, b in zip(at, at[1:])]
        assert value is None if not steps else abs(value - sum(steps) / len(steps)) < 1e-5


def test_added_spans_overlap_no_base_span(spark, ratios):
    key = base64.b64encode(hashlib.sha256(b"k").digest()).decode()
    text = f"token={key} and {key} é {key}"
    (row,) = sc.find_secrets(documents(spark, [(1, text)]), ratios).collect()
    assert [s.kind for s in row.base] == ["assign"]
    assert [text[s.start:s.end] for s in row.added] == [key, key]


def test_keys_within_long_words_and_beside_base_spans(spark, ratios):
    pick = random.Random(12)
    key = lambda n: "".join(pick.choice("abcdefghjkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(n))
    texts, want = [], []
    for i in range(40):
        one, two = key(28), key(40)
        path = "hooks/services/" + "/".join(prose(i, 3).split()) + "/"
        texts += [f"see {path}{one} now", f"{two}token=abcdef", f"{'0f' * 12}-{two}", f"{path}{path}"]
        want += [[one], [two], [two], []]
    rows = {r.doc_id: r for r in sc.find_secrets(documents(spark, list(enumerate(texts))), ratios).collect()}
    got = [[texts[i][s.start:s.end] for s in rows[i].added] for i in range(len(texts))]
    right = sum(g == w or (len(w) == 1 and len(g) == 1 and g[0].startswith(w[0]) and i % 4 == 1) for i, (g, w) in enumerate(zip(got, want)))
    assert right >= 0.93 * len(texts), [(t, g) for t, g, w in zip(texts, got, want) if g != w][:5]
    for i, r in rows.items():
        assert all(a.end <= b.start or b.end <= a.start for a in r.added for b in r.base)


def test_every_document_counts_in_the_ordinary_model(spark):
    docs = documents(spark, [(i, "plain words") for i in range(50)] + [(99, "qqzzqq")])
    words = {r["sample"]: r.times for r in sc.labelled_samples(spark, docs).filter("not random").collect()}
    assert words["plain"] == 50 and words["qqzzqq"] == 1


def test_running_sums(spark):
    for n in (0, 1, 511, 512, 513, 2000):
        (got,) = spark.range(1).select(sc.running_sums(F.transform(
            F.when(F.lit(n) > 0, F.sequence(F.lit(1), F.lit(max(n, 1)))).otherwise(F.array().cast("array<int>")),
            lambda x: x.cast("long")))).first()
        assert got == [i * (i + 1) // 2 for i in range(1, n + 1)]


def test_plan_has_no_python_and_no_shuffle(spark, ratios):
    plan = sc.find_secrets(documents(spark, [(1, "x")]), ratios)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
