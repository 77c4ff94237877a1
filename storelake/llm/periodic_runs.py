"""Periodic runs of words, found with a dictionary of basic factors.

A basic factor is a stretch of a power of two of words. Factors of one length are named by integers:
those of a single word by the word, longer ones by the pair of names of their halves; a factor that
occurs once in its text gets no name, nor do those around it. Occurrences of a factor of length L within
a window of 2 * L words form an arithmetic progression whose difference is a period of the text there.
So each occurrence is held against its successor, if that begins at most L words on; neighbouring
positions with the same difference p extend each other to one stretch, and that is a whole run of
smallest period p: were a neighbouring word to fit, its factor would have the same successor, and a
smaller period would bring a nearer one. A run shows at each length from p on and is kept once.

With three repeats or more, a run of period p holds two occurrences of a factor of length L for some power
of two L in [p, 2 * p), so none is missed. Each length costs one sort of the factors that occur again.
Work is within a row and there is no shuffle. Texts go through numpy in slices of bounded size; a longer
text is a slice of its own, split into words in pieces, so that only its integers are held at once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.shared import let, slices, word_pieces

MIN_REPEATS = 4
MIN_WORDS = 6
_SLICE = 1 << 21  # Bytes of text whose words are sorted together.
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
# Fixed value: words of a text.
WORD = "[^\\x20\\x09-\\x0D]+"


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Integers of the words of some texts, one after another, and where each text begins (and the last ends)."""
    vocabulary: dict[bytes, int] = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    parts, ends = [np.zeros(0, np.int64)], [0]
    for text in texts:
        n = 0
        for words in word_pieces(text):
            parts.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
            n += len(words)
        ends.append(ends[-1] + n)
    return np.concatenate(parts), np.array(ends)


def _stretches(at: np.ndarray, gap: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the stretches of neighbouring positions whose successors have the same distance."""
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(gap) != 0))
    first, last = np.append(0, cut + 1), np.append(cut, len(at) - 1)
    return at[first], at[last] - at[first] + gap[first] + length, gap[first]


def runs_of(codes: np.ndarray, ends: np.ndarray, min_repeats: int = MIN_REPEATS,
            min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs within each text, by start, then period; starts count over all texts."""
    if min_repeats < 3:
        raise ValueError("runs of fewer than three repeats need not show among the factors")
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    at, key = np.arange(len(codes)), owner * (codes.max(initial=0) + 1) + codes
    longest, length, found = int(np.diff(ends).max(initial=0)), 1, []
    while len(at) > 1 and length < 2 * (longest // min_repeats) + 1:
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        same = key[1:] == key[:-1]
        gap = np.diff(at)
        near = same & (gap <= length)
        if near.any():
            place = np.argsort(at[:-1][near])
            start, size, period = _stretches(at[:-1][near][place], gap[near][place], length)
            long_enough = size >= np.maximum(min_words, min_repeats * period)
            found.append(np.stack([start, size, period], axis=1)[long_enough])
        again = np.append(same, False) | np.append(False, same)
        names = np.full(len(codes) + length, -1)
        names[at[again]] = np.cumsum(np.append(True, ~same))[again]
        at = np.sort(at[again])
        # A factor of twice the length is the pair of its halves, both of one text.
        at = at[names[at + length] >= 0]
        at = at[owner[at] == owner[at + length]]
        key = names[at] * (len(codes) + 1) + names[at + length]
        length *= 2
    rows = np.unique(np.concatenate([np.zeros((0, 3), np.int64), *found]), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _collapsed(text: bytes, n: int, runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by single blanks."""
    if not len(runs):
        return b" ".join(b" ".join(words) for words in word_pieces(text))
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    keep, kept, at = np.cumsum(change) == 0, [], 0
    for words in word_pieces(text):
        kept += [words[i] for i in np.flatnonzero(keep[at:at + len(words)]).tolist()]
        at += len(words)
    return b" ".join(kept)


def periodic_runs(docs: DataFrame, min_repeats: int = MIN_REPEATS, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``docs``.

    ``runs`` holds (start, length, period) in words, numbered from 0, by start, then period: stretches of
    ``min_repeats`` periods and ``min_words`` words at least that no neighbouring word extends. ``collapsed``
    is the text without the words that a run holds after its first period, with single blanks.

    Null and empty texts have no words and no runs, and an empty text is left of them. Repeated rows get equal
    answers, runs may overlap and all are given, an empty table gives no rows, other columns are not read.
    A very long text takes memory for its words' integers, about ten times its bytes. ``min_repeats`` is three
    or more.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = pc.fill_null(batch.column(1), "").cast(pa.binary())
            sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
            for first, end in slices(sizes, _SLICE):
                texts = column.slice(first, end - first).to_pylist()
                codes, ends = word_codes(texts)
                runs = runs_of(codes, ends, min_repeats, min_words)
                bounds = np.searchsorted(runs[:, 0], ends)
                runs[:, 0] -= ends[np.searchsorted(ends, runs[:, 0], "right") - 1]
                left = [_collapsed(text, ends[i + 1] - ends[i], runs[bounds[i]:bounds[i + 1]]) for i, text in enumerate(texts)]
                listed = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], fields=list(_RUN)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(np.diff(ends), pa.int64()), listed,
                     pa.array(left, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {ids}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text), the text of one document in ten made periodic from some word on, as the id's checksum says.

    Texts without words and rows without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, F.nullif(n, F.lit(0))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return let(F.struct(a.alias("a"), p.alias("p")), lambda at: F.when(n > 0, F.concat_ws(" ", F.transform(
            words, lambda w, i: F.when(i < at["a"], w).otherwise(F.get(words, at["a"] + (i - at["a"]) % at["p"]))))).otherwise(
                F.col("text")))

    text = F.when(h % 10 == 0, let(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Counts, the run of the greatest exponent, and digests of all runs and of the collapsed text."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    best = F.aggregate("runs", F.lit(None).cast(kind), lambda held, r: F.when(
        held.isNull() | (r["length"] * held["period"] > held["length"] * r["period"]), r).otherwise(held))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.call_function("div", 1000 * F.col("best.length"), F.col("best.period"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")
