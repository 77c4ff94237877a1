"""Secret scan in DataFrame functions: fixed patterns, and Markov models of characters that add what they miss.

Two first-order models give the chance of a character after another: one of random strings, one of
ordinary identifiers. Both are counted from labelled samples, the ordinary ones from the words of all documents.
Of a long word, or of what a fixed pattern leaves of it, the stretch that favours the random model most is a
secret if its mean log-likelihood ratio per step is high enough, so that a key at the end of a path is found
and the path is not. Everything is computed within the row, JVM-side and without a shuffle; for training words
are merged map-side, and only counts of steps are gathered, a table of fixed size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm.shared import count_kinds, let, spans_text

# The patterns of the base kinds, in their order.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 6  # Characters of an assigned value.

# Ordinary identifiers as they occur in programs and texts.
IDENTIFIERS = (
    "getUserName", "setMaximumValue", "max_partition_bytes", "spark_sql_shuffle_partitions", "created_at",
    "UPDATED_AT", "customerEmailAddress", "order_item_count", "total-price-in-usd", "http_request_timeout",
    "MAX_RETRY_COUNT", "DatabaseConnectionPool", "application/x-www-form-urlencoded", "user_id", "session_key",
    "NullPointerException", "readOnlyFileSystem", "src/main/resources/config", "usr/local/lib/python3", "test_case_01",
    "version_2_10_3", "2024-01-31", "2019-2020", "chapter_12", "section-4", "image_0042", "IMG_20240131", "page-100",
    "utf8_general_ci", "ISO-8859-1", "sha256_checksum", "base64_encoded_payload", "left_outer_join", "data-testid",
    "background-color", "Content-Type", "X-Forwarded-For", "en_US", "america/new_york", "README", "LICENSE_INFORMATION",
    "thisIsAnOrdinaryIdentifier", "the_quick_brown_fox", "jumps_over_the_lazy_dog", "internationalization",
    "counterrevolutionaries", "antidisestablishment", "incomprehensibilities", "--------------------",
    "====================", "____________________", "1000000", "0000000000", "1234567890", "aaaaaaaaaaaaaaaaaaaa",
)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIZE = len(ALPHABET) + 1
_WORD = "[A-Za-z0-9+/_=-]"
LONG_WORD = 20
RANDOM_SAMPLES = 600  # Of each sort of random string.
THRESHOLD = 0.5  # Mean log-likelihood ratio per step.
_CHUNK = 512


# --- models -----------------------------------------------------------------------------------


def labelled_samples(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(sample, random, times): random strings made by rule, and identifiers: fixed ones and the words of all documents.

    Words with digits are left out, since a document may hold secrets; each word counts as it is, in
    upper case and with a capital.
    """
    digest = F.sha2(F.col("id").cast("string"), 256)
    packed = F.regexp_replace(F.base64(F.unhex(digest)), "=", "")
    made = spark.range(RANDOM_SAMPLES).select(F.explode(F.array(
        F.substring(digest, 1, 40), packed, F.translate(packed, "+/", "-_"),
        F.upper(F.translate(packed, "+/abcdefghijklm", "")))).alias("sample"))
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(f"{_WORD}{{2,}}"), F.lit(0))).alias("word"))
    plain = words.filter(~F.col("word").rlike("[0-9]")).groupBy("word").agg(F.count("*").alias("times"))
    forms = plain.select(F.explode(F.array("word", F.upper("word"), F.initcap("word"))).alias("sample"), "times")
    fixed = F.explode(F.array(*[F.lit(x) for x in IDENTIFIERS])).alias("sample")
    return (made.select("sample", F.lit(True).alias("random"), F.lit(1).cast("long").alias("times"))
            .unionByName(spark.range(1).select(fixed, F.lit(False).alias("random"), F.lit(20).cast("long").alias("times")))
            .unionByName(forms.select("sample", F.lit(False).alias("random"), "times")))


def _symbol(character: Column) -> Column:
    return F.instr(F.lit(ALPHABET), character)


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _steps(text: Column) -> Column:
    """The number of each pair of neighbouring characters."""
    return let(F.transform(_characters(text), _symbol), lambda s: F.when(F.size(s) > 1, F.zip_with(
        F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: a * _SIZE + b)).otherwise(
            F.array().cast("array<int>")))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratio of each step, random over ordinary, from (sample, random, times).

    The chance of a character after another is its smoothed share of the steps from that one. Without
    samples of a sort its model is uniform.
    """
    counted = samples.select("random", "times", F.explode(_steps(F.col("sample"))).alias("step")).groupBy(
        "random", "step").agg(F.sum("times").alias("n"))
    counts = {True: [smoothing] * _SIZE**2, False: [smoothing] * _SIZE**2}
    for row in counted.collect():  # At most 2 * 68 * 68 rows.
        counts[row["random"]][row["step"]] += row["n"]
    logs = {}
    for label, held in counts.items():
        totals = [sum(held[a * _SIZE:(a + 1) * _SIZE]) for a in range(_SIZE)]
        logs[label] = [math.log(x / totals[i // _SIZE]) for i, x in enumerate(held)]
    return [r - o for r, o in zip(logs[True], logs[False])]


def _ratios(word: Column, ratios: list[float]) -> Column:
    """Log-likelihood ratio of each step of a word."""
    # Folded into one literal, so that a lookup is an array access.
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    return F.transform(_steps(word), lambda s: F.element_at(table, s + 1))


def _mean(ratio: Column) -> Column:
    return F.aggregate(ratio, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(ratio), F.lit(0))


def mean_ratio(word: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio per step of a word; null for fewer than two characters."""
    return let(_ratios(word, ratios), _mean)


def random_stretch(word: Column, ratios: list[float], threshold: float) -> Column:
    """(from, to) in a word: the steps whose ratios exceed the threshold by the largest sum, cut to whole runs of letters and digits.

    Null where no step exceeds it, where the stretch is shorter than ``LONG_WORD``, or where its mean does not
    exceed the threshold. Padding at the word's end belongs to it.
    """
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("first"), F.lit(0.0).alias("best"), F.lit(0).alias("from"), F.lit(0).alias("to"))

    def step(held: Column, e: Column) -> Column:
        anew = held["sum"] <= 0
        total = F.when(anew, F.lit(0.0)).otherwise(held["sum"]) + e["x"] - F.lit(threshold)
        first = F.when(anew, e["i"]).otherwise(held["first"])
        return let(F.struct(total.alias("sum"), first.alias("first")), lambda now: F.struct(
            now["sum"].alias("sum"), now["first"].alias("first"), F.greatest(held["best"], now["sum"]).alias("best"),
            F.when(now["sum"] > held["best"], now["first"]).otherwise(held["from"]).alias("from"),
            F.when(now["sum"] > held["best"], e["i"] + 2).otherwise(held["to"]).alias("to")))

    def run(text: Column, pattern: str) -> Column:
        return F.char_length(F.regexp_extract(text, pattern, 0))

    def grown(found: Column) -> Column:
        """Whole runs of letters and digits: one that is cut is taken if the larger part of it lies inside, else left."""
        head, tail = F.substring(word, 1, found["from"]), F.substring(word, found["from"] + 1, F.char_length(word))
        begun, until = F.substring(word, 1, found["to"]), F.substring(word, found["to"] + 1, F.char_length(word))
        sizes = F.struct(
            run(head, "[A-Za-z0-9]*$").alias("before"), run(tail, "^[A-Za-z0-9]*").alias("first"),
            run(tail, "^[A-Za-z0-9]*[^A-Za-z0-9]*").alias("skipped"), run(begun, "[A-Za-z0-9]*$").alias("last"),
            run(begun, "[^A-Za-z0-9]*[A-Za-z0-9]*$").alias("dropped"), run(until, "^[A-Za-z0-9]*").alias("after"))
        aligned = let(sizes, lambda n: F.struct(
            (found["from"] + F.when((n["first"] > 0) & (n["first"] >= n["before"]), -n["before"]).otherwise(n["skipped"])).alias("from"),
            (found["to"] + F.when((n["last"] > 0) & (n["last"] >= n["after"]), n["after"]).otherwise(-n["dropped"])).alias("to")))
        return let(aligned, lambda ends: F.struct(ends["from"].alias("from"), (ends["to"] + run(
            F.substring(word, ends["to"] + 1, F.char_length(word)), "^=+$")).alias("to")))

    def kept(ratio: Column, ends: Column) -> Column:
        mean = let(F.slice(ratio, ends["from"] + 1, F.greatest(ends["to"] - ends["from"] - 1, F.lit(0))), _mean)
        return F.when((ends["to"] - ends["from"] >= LONG_WORD) & (mean > threshold), ends)

    def found(ratio: Column) -> Column:
        indexed = F.transform(ratio, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        return let(F.aggregate(indexed, start, step), lambda held: F.when(
            held["best"] > 0, let(grown(held), lambda ends: kept(ratio, ends))))

    return let(_ratios(word, ratios), found)


# --- spans ------------------------------------------------------------------------------------


def running_sums(steps: Column) -> Column:
    """Inclusive running sums of an array of long, in chunks, so that work does not grow with its square."""
    zero = F.lit(0).cast("long")

    def add(values: Column) -> Column:
        return F.aggregate(values, zero, lambda a, x: a + x)

    def before_chunks(steps: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _CHUNK).cast("int"))
        totals = F.transform(chunks, lambda c: add(F.slice(steps, c * _CHUNK + 1, F.lit(_CHUNK))))
        start = F.struct(zero.alias("sum"), F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(totals, start, lambda a, x: F.struct(
            (a["sum"] + x).alias("sum"), F.concat(a["before"], F.array(a["sum"])).alias("before")))["before"]

    def sums(steps: Column) -> Column:
        chunk = lambda i: F.floor(i / _CHUNK).cast("int")
        return let(before_chunks(steps), lambda before: F.transform(steps, lambda _, i: (
            F.get(before, chunk(i)) + add(F.slice(steps, chunk(i) * _CHUNK + 1, i % _CHUNK + 1)))))

    return let(steps, lambda s: F.when(F.size(s) > 0, sums(s)).otherwise(F.array().cast("array<bigint>")))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches as (start, end, word, value) in code points: the gaps between them tell where they are."""
    def places(found: Column, gaps: Column) -> Column:
        steps = F.transform(found, lambda m, i: (
            F.char_length(F.get(gaps, i))
            + F.when(i > 0, F.char_length(F.get(found, i - 1))).otherwise(0)).cast("long"))
        return running_sums(steps)

    def rows(found: Column, starts: Column, values: Column) -> Column:
        return F.transform(found, lambda m, i: F.struct(
            F.get(starts, i).alias("start"), (F.get(starts, i) + F.char_length(m)).alias("end"), m.alias("word"),
            F.get(values, i).alias("value")))

    def located(found: Column) -> Column:
        starts = let(F.split(text, pattern, -1), lambda gaps: places(found, gaps))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
        return let(starts, lambda s: let(values, lambda v: rows(found, s, v)))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


_SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint>"


def _spans(found: Column, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(KINDS[rank]).alias("kind"), m["end"].alias("end")))


def find_secrets(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, base, added) per row of ``docs``: spans as (start, rank, kind, end), in code points, end exclusive.

    Null text counts as empty and has no spans. Added spans are of the kind ``random`` and overlap no base
    span: one at most of each long word, or of each long piece that base spans leave of it. Repeated rows get equal
    answers, an empty table gives no rows; other columns, whatever their names, are not read. Very long texts are
    searched whole.
    """
    none = F.array().cast(f"array<{_SPAN}>")
    long_word = f"(?<!{_WORD}){_WORD}{{{LONG_WORD},}}"
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Every access key and long hex run lies within a long word; an assignment needs its sign.
    texts = texts.withColumn("has_long", F.size(F.regexp_extract_all("text", F.lit(long_word), F.lit(0))) > 0)
    text = F.col("text")
    signed = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    long_enough = lambda m: F.char_length(m["value"]) >= MIN_VALUE
    base = F.concat(
        F.when(signed, _spans(F.filter(matches(text, ASSIGN, 2), long_enough), 0)).otherwise(none),
        F.when(F.col("has_long") & F.contains(text, F.lit("AKIA")), _spans(matches(text, ACCESS), 1)).otherwise(none),
        F.when(F.col("has_long"), _spans(matches(text, HEX), 2)).otherwise(none))
    words = texts.select("doc_id", "text", "has_long", F.array_sort(base).alias("base"))
    random = F.flatten(F.transform(matches(text, long_word), lambda w: _pieces(w, long_word)))
    secret = F.transform(random, lambda w: let(random_stretch(w["word"], ratios, threshold), lambda at: F.when(
        at.isNotNull(), F.struct((w["start"] + at["from"]).alias("start"), (w["start"] + at["to"]).alias("end")))))
    return words.select("doc_id", "base", F.when(F.col("has_long"), _spans(F.array_compact(secret), 3)).otherwise(none).alias("added"))


def _pieces(word: Column, long_word: str) -> Column:
    """The long pieces of a word that lie beside base spans; the word itself if it meets none."""
    def cut(spans: Column) -> Column:
        def blanked(held: Column, b: Column) -> Column:
            free = F.greatest(b["start"] - word["start"] - held["at"], F.lit(0))
            upto = F.greatest(held["at"], F.least(b["end"], word["end"]) - word["start"])
            return F.struct(upto.alias("at"), F.concat(
                held["text"], F.substring(word["word"], (held["at"] + 1).cast("int"), free.cast("int")),
                F.repeat(F.lit(" "), (upto - held["at"] - free).cast("int"))).alias("text"))
        begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("text"))
        return let(F.aggregate(spans, begin, blanked), lambda held: F.concat(
            held["text"], F.substring(word["word"], (held["at"] + 1).cast("int"), F.char_length(word["word"]))))

    def pieces(text: Column) -> Column:
        return F.transform(matches(text, long_word), lambda m: F.struct(
            (word["start"] + m["start"]).alias("start"), (word["start"] + m["end"]).alias("end"), m["word"].alias("word")))

    whole = F.array(F.struct(word["start"].alias("start"), word["end"].alias("end"), word["word"].alias("word")))
    meets = F.filter("base", lambda b: (b["start"] < word["end"]) & (word["start"] < b["end"]))
    return let(meets, lambda spans: F.when(F.size(spans) == 0, whole).otherwise(let(cut(spans), pieces)))


def secret_digests(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """Counts and digest of the base spans, all spans as text, and the number of spans that the models add."""
    learned = train(labelled_samples(docs.sparkSession, docs)) if ratios is None else ratios
    found = find_secrets(docs, learned)
    return found.select(
        "doc_id", *count_kinds("base", KINDS[:3]), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_random"))
