import hashlib
import random

from storelake.llm import chat_format as cf

TURNS = "conv_id long, turn long, role string, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(got, rows):
    """Every conversation's digests against its own rows."""
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert len(got) == len(by_conv)
    for r in got:
        own = sorted(by_conv[r.conv_id])
        loss = "".join(t for _, _, role, t in own if role == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == digest("".join(f"{role}\n{t}\n" for _, _, role, t in own))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), digest(loss))


def test_probe_and_plain_conversations(spark):
    rows = [(1, 1, "assistant", "hello é"), (1, 0, "user", "hi"), (1, 2, "tool", "x"), (2, 0, "system", None), (2, 1, "user", "")]
    docs = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS formatted", "1 AS level", "2 AS turns")
    got = cf.format_digests(cf.with_probe(docs)).collect()
    check(got, [*rows, (-1, 0, "user", cf.PROBE), (-1, 1, "assistant", cf.PROBE)])
    assert {r.conv_id: r.escape_level for r in got} == {1: 0, 2: 0, -1: 1}
    formatted = {r.conv_id: r for r in cf.format_conversations(cf.with_probe(docs)).collect()}
    assert formatted[1].formatted == "#0\n<s>user\n[INST] hi [/INST]</s><s>assistant\nhello é</s><s>tool\nx</s>"
    assert [formatted[1].formatted[s.start:s.end] for s in formatted[1].loss_spans] == ["hello é"]
    assert formatted[-1].formatted.count("</s>") == 2 and formatted[-1].formatted.count("[INST]") == 1


def test_round_trip_of_hostile_content(spark):
    pick = random.Random(1)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<", "/s>", "[", "&", "&lt;", "&amp;", "&#91;", "&#10;", "\n", "#1\n",
            "user", "assistant", " ", "é😀", "s>", "\\", "$1", "<s>user\n[INST] x [/INST]</s>"]
    text = lambda n: "".join(pick.choice(bits) for _ in range(pick.randrange(n)))
    roles = ["user", "assistant", "system", "tool", None, "", "a\nb", "<s>", "&lt;", "[INST]", "</s>x"]
    rows = [(conv, turn, pick.choice(roles), text(8)) for conv in range(150) for turn in range(pick.randrange(1, 5))]
    check(cf.format_digests(spark.createDataFrame(rows, TURNS)).collect(), rows)


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "a"), (None, None, None, None), (3, None, "user", "b"), (3, 1, "user", "c"), (4, 1, "user", "z"),
            (4, 1, "user", "y"), (4, 1, "assistant", "y"), (5, 1, "assistant", "twice"), (5, 1, "assistant", "twice"),
            (6, 0, "assistant", "long é " * 100_000)]
    rows += [(7, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(2000)]
    check(cf.format_digests(spark.createDataFrame(rows, TURNS)).collect(), rows)
    assert cf.format_digests(spark.createDataFrame([], TURNS)).collect() == []


def test_parser_rejects_what_is_no_output(spark):
    bad = ["", "#0\n<s>user\nx</s>", "#0\n<s>tool\nx", "#0\ntool\nx</s>", "#0\n<s>tool</s>", "#0\n<s>tool\n[INST]</s>"]
    frame = spark.createDataFrame([(b,) for b in bad], "f string")
    assert [r[0] for r in frame.select(cf.parse(frame["f"])).collect()][1:] == [None] * 5


def test_plan_has_no_python(spark):
    plan = cf.format_digests(spark.createDataFrame([(1, 0, "user", "x")], TURNS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
