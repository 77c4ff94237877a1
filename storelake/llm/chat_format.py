"""Chat formatting with a grammar round trip, in DataFrame functions.

A conversation is rendered by a template, parsed again by a deterministic parser, and compared with its
turns. Where they differ, or a text holds a control string, content is escaped one level further and the
round trip repeated, until the turns come back identical.

    text    = "#" level LF turn*
    turn    = "<s>" role LF body "</s>"
    body    = "[INST] " text " [/INST]" (user) | "<<SYS>> " text " <</SYS>>" (system) | text (others)

Level 0 escapes nothing. Level 1 escapes the first character of each control string in texts, and roles
fully. Level 2 escapes every character that a control string can begin with, so that the round trip
cannot fail.

Scale: turns are gathered by conversation, which is the result's row; a conversation is as large as its
formatted text. No other data move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.secrets import running_sums
from storelake.llm.shared import let

# The template's control strings.
OPEN, CLOSE = "<s>", "</s>"
WRAPPERS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>> ", " <</SYS>>")}
CONTROL = "</?s>|\\[/?INST\\]|<</?SYS>>"
TRAINED_ROLE = "assistant"
LEVELS = 3
PROBE = "</s>[INST] ok [/INST]"


def _escape(text: Column, level: int) -> Column:
    if level == 0:
        return text
    safe = F.replace(text, F.lit("&"), F.lit("&amp;"))
    if level == 1:
        safe = F.regexp_replace(safe, "<(?=/?s>|</?SYS>>)", "&lt;")
        return F.regexp_replace(safe, "\\[(?=/?INST\\])", "&#91;")
    return F.replace(F.replace(safe, F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&#91;"))


def _escape_role(role: Column, level: int) -> Column:
    return F.replace(_escape(role, 2), F.lit("\n"), F.lit("&#10;")) if level else role


def unescape(text: Column) -> Column:
    for code, character in (("&lt;", "<"), ("&#91;", "["), ("&#10;", "\n"), ("&amp;", "&")):
        text = F.replace(text, F.lit(code), F.lit(character))
    return text


def _wrapper(role: Column, end: int) -> Column:
    out = F.lit("")
    for name, marks in WRAPPERS.items():
        out = F.when(role == name, marks[end]).otherwise(out)
    return out


def _pieces(turns: Column, level: int) -> Column:
    """Per turn what stands before its text, the escaped text, and what stands after."""
    return F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(OPEN), _escape_role(t["role"], level), F.lit("\n"), _wrapper(t["role"], 0)).alias("before"),
        _escape(t["text"], level).alias("text"),
        F.concat(_wrapper(t["role"], 1), F.lit(CLOSE)).alias("after"),
        (t["role"] == TRAINED_ROLE).alias("trained")))


def _render(pieces: Column, level: int) -> Column:
    whole = F.transform(pieces, lambda p: F.concat(p["before"], p["text"], p["after"]))
    return F.concat(F.lit(f"#{level}\n"), F.array_join(whole, ""))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text; null if it is none."""
    def turn(chunk: Column, head: Column, escaped: Column) -> Column:
        plain = lambda c: F.when(escaped, unescape(c)).otherwise(c)
        return let(F.struct(
            (F.startswith(chunk, F.lit(OPEN)) & F.contains(chunk, F.lit("\n"))).alias("opened"),
            plain(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"), F.substr(chunk, F.char_length(head) + 2).alias("body")),
            lambda t: let(F.struct(_wrapper(t["role"], 0).alias("a"), _wrapper(t["role"], 1).alias("b")), lambda w: let(
                F.substr(t["body"], F.char_length(w["a"]) + 1,
                         F.char_length(t["body"]) - F.char_length(w["a"]) - F.char_length(w["b"])),
                lambda raw: F.struct(
                    (t["opened"] & F.startswith(t["body"], w["a"]) & F.endswith(t["body"], w["b"])
                     & ~F.rlike(raw, F.lit(CONTROL))).alias("sound"),
                    t["role"].alias("role"), plain(raw).alias("text")))))

    def turns(chunks: Column, escaped: Column) -> Column:
        own = F.transform(F.slice(chunks, 1, F.size(chunks) - 1), lambda c: let(
            F.substring_index(c, "\n", 1), lambda head: turn(c, head, escaped)))
        return let(own, lambda o: F.when(
            (F.get(chunks, F.size(chunks) - 1) == "") & F.forall(o, lambda t: t["sound"]),
            F.transform(o, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))))

    level = F.substring_index(formatted, "\n", 1)
    rest = F.substr(formatted, F.char_length(level) + 2)
    return let(F.split(rest, CLOSE, -1), lambda chunks: turns(chunks, level != "#0"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, escape_level, loss_spans) per conversation.

    Rows (conv_id, turn, role, text) are taken by turn, ties by role and text; a null turn comes first. A
    null text or role is empty, rows without conv_id are one conversation, repeated rows are repeated turns.
    An empty table gives no rows; other columns, whatever their names, are not read. A conversation is one row
    however long, as its formatted text is. ``loss_spans`` are the (start, end) of each
    assistant text in the formatted text, in code points.
    """
    rows = conversations.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    tried = gathered.select("conv_id", F.transform("rows", lambda r: F.struct(
        r["role"].alias("role"), r["text"].alias("text"))).alias("turns"))
    tried = tried.withColumns({"level": F.lit(0), "pieces": _pieces(F.col("turns"), 0)})
    tried = tried.withColumn("formatted", _render(F.col("pieces"), 0))
    for level in range(1, LEVELS):
        tried = tried.withColumn("same", parse(F.col("formatted")).eqNullSafe(F.col("turns")))
        again = _pieces(F.col("turns"), level)
        tried = tried.withColumns({
            "level": F.when(F.col("same"), F.col("level")).otherwise(level),
            "pieces": F.when(F.col("same"), F.col("pieces")).otherwise(again)})
        tried = tried.withColumn("formatted", F.when(F.col("same"), F.col("formatted")).otherwise(
            _render(F.col("pieces"), level)))
    size = lambda p, *names: sum((F.char_length(p[n]) for n in names[1:]), F.char_length(p[names[0]])).cast("long")
    ends = running_sums(F.transform("pieces", lambda p: size(p, "before", "text", "after")))
    loss = let(ends, lambda e: F.filter(F.transform("pieces", lambda p, i: F.struct(
        (F.get(e, i) + 3 - size(p, "text", "after")).alias("start"), (F.get(e, i) + 3 - size(p, "after")).alias("end"),
        p["trained"].alias("trained"))), lambda s: s["trained"]))
    loss = F.transform(loss, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return tried.select("conv_id", "formatted", F.col("level").alias("escape_level"), loss.alias("loss_spans"))


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations, and one of id -1 whose texts look like the template itself."""
    kept = conversations.select("conv_id", "turn", "role", "text")
    kinds = dict(kept.dtypes)
    probe = kept.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), F.lit(i).cast(kinds["turn"]).alias("turn"),
                 F.lit(role).alias("role"), F.lit(PROBE).alias("text"))
        for i, role in enumerate(("user", TRAINED_ROLE))])).alias("r")).select("r.*")
    return kept.unionByName(probe)


def format_digests(conversations: DataFrame) -> DataFrame:
    """What the formatted texts say, read back from them: turns by the parser, loss by the mask."""
    found = format_conversations(conversations).withColumn("turns", parse(F.col("formatted")))
    masked = F.transform("loss_spans", lambda s: F.substr(
        "formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    plain = F.transform(masked, lambda m: F.when(F.col("escape_level") > 0, unescape(m)).otherwise(m))
    found = found.withColumn("loss", F.array_join(plain, ""))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "escape_level")
