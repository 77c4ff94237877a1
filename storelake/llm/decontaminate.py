"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters has an error budget of k edits and is split into k + 1 pieces: wherever the
item occurs with at most k edits, one piece occurs unchanged. An automaton over all pieces finds their
hits in a document in one pass; around each hit the whole item is verified with Myers' bit-parallel
edit distance. Texts are compared lower-cased, with runs of white space as one blank.

An item below ``min_chars`` characters may be plain speech with an edit more, so it is sought word for
word: no edits, and between word boundaries where its script has them.

Scale: documents are not shuffled. Items are read from the benchmark table in blocks of bounded size. A block is
broadcast and run over all documents; where there are several, each writes its hits before the next is read, so
that one block and one automaton are held at a time, and the hits meet the documents by row at the end. A window
with many occurrences is scanned once.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain, islice
from uuid import uuid4

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.shared import stored

BLOCK_CHARS = 1_000_000  # Characters of items in one broadcast.
ERROR_RATE = 0.05
MIN_CHARS = 25  # Shorter items are sought without edits.
# Thai to Tibetan, Burmese, Khmer, ideographs with kana and bopomofo, half-width kana, later ideographs.
NO_BLANKS = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31A0, 0x31FF),
             (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF))

Hit = tuple[int, int, int, int]  # Item, start, end (in the normalised text), edits.
_HITS = "array<struct<item_id:{ids},start:int,end:int,edits:int>>"


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` neighbouring pieces of near equal length, each with its offset."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def scores(m: int, masks: dict[str, int], window: str) -> Iterator[int]:
    """For each place of the window the least edits with which an item of m characters ends there."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    for c in window:
        eq = masks.get(c, 0)
        cross = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(cross | plus) & full
        down = plus & cross
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full  # The item may begin anywhere.
        down = down << 1 & full
        vertical = eq | minus
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical
        yield score


def myers(item: str, window: str, budget: int) -> tuple[int, int] | None:
    """Least edits with which the item occurs in the window, and the end of its first best occurrence; None above the budget."""
    best = min(((s, j) for j, s in enumerate(scores(len(item), masks_of(item), window), 1)), default=None)
    return best if best and best[0] <= budget else None


def minima(found: Iterator[int], budget: int) -> list[tuple[int, int]]:
    """(edits, end) of the first least scores within the budget, the next one more than a budget further on."""
    out: list[tuple[int, int]] = []
    best = None
    for j, score in enumerate(found, 1):
        if best and (score > budget or j - best[1] > budget):
            out.append(best)
            best = None
        if score <= budget and (best is None or score < best[0]):
            best = (score, j)
    return out + [best] * (best is not None)


def is_mark(char: str) -> bool:
    return unicodedata.category(char).startswith("M")


def in_word(char: str) -> bool:
    """Part of a word that blanks or signs end; letters of scripts without blanks are not."""
    if any(a <= ord(char) <= b for a, b in NO_BLANKS):
        return False
    return char.isalnum() or char == "_" or is_mark(char)


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether ``text[start:end]`` cuts no word: it has word boundaries, or edges of a script without blanks.

    A mark that follows changes the last character. Signs alone must stand between blanks.
    """
    before, after = text[start - 1:start], text[end:end + 1]
    if after and is_mark(after):
        return False
    if not any(c.isalnum() for c in text[start:end]):
        return before in ("", " ") and after in ("", " ")
    return not (before and in_word(before) and in_word(text[start])
                or after and in_word(after) and in_word(text[end - 1]))


class Matcher:
    """Finds the items of one block in normalised texts; those below ``exact_below`` characters word for word."""

    def __init__(self, items: Sequence[tuple[object, str]], error_rate: float, exact_below: int = 0):
        self.exact_below = exact_below
        self.items = [(number, text, int(len(text) * error_rate) if len(text) >= exact_below else 0)
                      for number, text in items]
        self.masks: dict[int, tuple[dict[str, int], dict[str, int]]] = {}  # Of items that were verified.
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, budget) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                places.setdefault(piece, []).append((at, offset))
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def windows(self, text: str, exact: list[Hit]) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) wherever a hit allows an occurrence; windows of one item that touch are one.

        Hits of items sought word for word are whole occurrences and go to ``exact``.
        """
        found: dict[int, list[tuple[int, int]]] = {}
        for last, (length, places) in self.automaton.iter(text):
            for at, offset in places:
                number, item, budget = self.items[at]
                start = last + 1 - length - offset
                if len(item) < self.exact_below:
                    if stands_alone(text, start, last + 1):
                        exact.append((number, start, last + 1, 0))
                    continue
                window = max(0, start - budget), min(len(text), start + len(item) + budget)
                own = found.setdefault(at, [])
                if own and window[0] <= own[-1][1]:
                    own[-1] = (min(own[-1][0], window[0]), max(own[-1][1], window[1]))
                else:
                    own.append(window)
        for at, own in found.items():
            for start, end in own:
                yield at, start, end

    def find(self, text: str) -> list[Hit]:
        """Occurrences by place: of each item the best ones, and of equally good ones the first, that don't overlap."""
        out: list[Hit] = []
        if not self.items:
            return out
        for at, start, end in list(self.windows(text, out)):
            number, item, budget = self.items[at]
            forward, backward = self._masks(at)
            spans = []
            for edits, stop in minima(scores(len(item), forward, text[start:end]), budget):
                # The same search backwards from the end finds where it begins.
                back = text[max(start, start + stop - len(item) - edits):start + stop][::-1]
                first = min(((s, j) for j, s in enumerate(scores(len(item), backward, back), 1)), default=(0, len(item)))[1]
                spans.append((edits, start + stop - first, start + stop))
            chosen: list[tuple[int, int, int]] = []
            for edits, first, stop in sorted(spans):
                place = bisect(chosen, (first, stop, edits))
                if (place and chosen[place - 1][1] > first) or (place < len(chosen) and chosen[place][0] < stop):
                    continue
                chosen.insert(place, (first, stop, edits))
            out += [(number, first, stop, edits) for first, stop, edits in chosen]
        return sorted(out, key=lambda h: (h[1], str(h[0])))

    def _masks(self, at: int) -> tuple[dict[str, int], dict[str, int]]:
        if at not in self.masks:
            item = self.items[at][1]
            self.masks[at] = masks_of(item), masks_of(item[::-1])
        return self.masks[at]


def _blocks(benchmark: DataFrame, min_chars: int, block_chars: int, short: bool) -> Iterator[list[tuple[object, str]]]:
    """Distinct (item_id, normalised text) in blocks of bounded size; the driver holds one block at a time."""
    block, size = [], 0
    rows = benchmark.filter("text is not null").select("item_id", "text").distinct().orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        text = normalised(row["text"])
        if not text or len(text) < min_chars and not short:
            continue
        weight = max(len(text), min_chars)  # A short item costs more than its characters.
        if block and size + weight > block_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += weight
    if block:
        yield block


def _hits_of(block: Broadcast, error_rate: float, kind: str, min_chars: int):
    @F.pandas_udf(kind)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(block.value, error_rate, min_chars)  # Once per task.
        for texts in batches:
            found = [matcher.find(normalised(t)) for t in texts]
            yield pd.Series([[dict(zip(("item_id", "start", "end", "edits"), h)) for h in own] for own in found],
                            dtype=object)
    return hits


def with_hits(docs: DataFrame, benchmark: DataFrame, name: str, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS,
              block_chars: int = BLOCK_CHARS, short: bool = True) -> DataFrame:
    """``docs`` with a column ``name``: the occurrences of benchmark items as (item_id, start, end, edits).

    Offsets are code points of the normalised text. Null and empty texts have none, and so has any text
    where the benchmark is empty. Items with null or blank text are not sought; those with fewer than
    ``min_chars`` characters are sought word for word, without ``short`` not at all.
    """
    kind = _HITS.format(ids=benchmark.schema["item_id"].dataType.simpleString())
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, min_chars, block_chars, short)
    first = list(islice(blocks, 2))
    if not first:
        return docs.withColumn(name, F.array().cast(kind))
    if len(first) == 1:
        return docs.withColumn(name, _hits_of(context.broadcast(first[0]), error_rate, kind, min_chars)(F.col("text")))
    row = f"row_{uuid4().hex}"
    held = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    parts = []
    for block in chain(first, blocks):
        shared = context.broadcast(block)
        hits = held.select(row, _hits_of(shared, error_rate, kind, min_chars)(F.col("text")).alias("hits"))
        parts.append(stored(hits.filter(F.size("hits") > 0), "hits"))
        shared.unpersist()
    found = reduce(DataFrame.unionByName, parts).groupBy(row).agg(F.flatten(F.collect_list("hits")).alias(name))
    return held.join(found, row, "left").withColumn(name, F.coalesce(name, F.array().cast(kind))).drop(row)


def contamination(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE,
                  min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS, short: bool = True) -> DataFrame:
    """(doc_id, contaminated, n_items, items, spans) per row of ``docs``.

    ``items`` lists the ids found, ``spans`` each occurrence as item:start:end:edits by place; those of one item
    don't overlap. A null doc_id stays null, repeated rows get equal answers, empty tables give no rows or no hits;
    other columns, whatever their names, are not read. An item id that stands for several texts counts once. Very long
    texts are searched whole, in time that grows with their length.
    """
    found = with_hits(docs.select("doc_id", "text"), benchmark, "hits", error_rate, min_chars, block_chars, short)
    ids = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"])))
    by_place = F.array_sort(F.transform("hits", lambda h: F.struct(
        h["start"].alias("start"), h["end"].alias("end"), h["item_id"].alias("item_id"), h["edits"].alias("edits"))))
    spans = F.transform(by_place, lambda h: F.concat_ws(":", h["item_id"], h["start"], h["end"], h["edits"]))
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"),
        F.array_join(ids.cast("array<string>"), ",").alias("items"), F.array_join(spans, ",").alias("spans"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE,
                        short: bool = True) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay.

    Null and empty texts stay, repeated rows go or stay together, an empty benchmark takes nothing. Columns
    beside text may have any name.
    """
    name = f"hits_{uuid4().hex}"
    return with_hits(docs, benchmark, name, error_rate, short=short).filter(F.size(name) == 0).select(*docs.columns)
