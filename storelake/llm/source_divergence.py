"""How far the sources of a language differ in their words: hash-consed segment trees over term ids.

Terms that enough documents of a language hold get ids, by falling frequency. A group (language, source) is
the array of its counts over those ids, cut into blocks of a fixed number of ids, and over each block stands a
segment tree whose nodes are named by content: a leaf by its count, an inner node by the names of its halves.
So equal subtrees, of one group or of several, are one node; the rare terms that a group lacks make large
subtrees of zeros, all of one name. Two groups are compared by going down both trees at once: the pairs of
nodes at a level are kept with how often they occur, and a pair that occurs again is expanded and priced once.

Scale: documents are counted where they are read and merged map-side. Ids come from a sort by ranges. A task
compares two tiles of sources over one block of ids, so its memory is bounded whatever the vocabulary and the
number of sources; the partial sums meet in an aggregate. All arithmetic is in integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.shared import stored, word_pieces
from storelake.operators.numbering import numbered

MIN_DOCS = 30  # Documents of a language that hold a term.
TOP_TERMS = 50
BLOCK = 4096  # Term ids to a tree.
TILE = 32  # Sources of a tile.
SMOOTHING, SCALE = 5, 1_000_000_000
_HELD = 1 << 18  # Terms that a task counts before it hands them on.

# Letters and everything beyond ASCII make terms, A-Z count as a-z, all else is a blank.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


# --- counting ---------------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term of a group; a null term carries the group itself."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            rows = len(terms) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * rows, pa.string()), pa.array([source] * rows, pa.string()),
                 pa.array([*terms, None], pa.binary()).cast(pa.string()),
                 pa.array([*n.values(), 0], pa.int64()), pa.array([*(docs[t] for t in terms), 0], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        texts = batch.column(0).cast(pa.binary())
        for lang, source, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), texts):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            size -= len(n)
            for terms in word_pieces(text.as_py().translate(_TERMS)):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            size += len(n)
            if size > _HELD:
                yield from flush()
                size = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; every group has a row with a null term too."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    found = docs.select(*blank).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- trees ------------------------------------------------------------------------------------


def price(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTHING) / total), three digits at a time, so that no product leaves 64 bits."""
    quotient, rest = np.zeros_like(count), count + SMOOTHING
    for _ in range(3):
        rest = rest * 1000
        quotient, rest = quotient * 1000 + rest // total, rest % total
    return quotient + 1


class Forest:
    """Segment trees over the rows of an array of counts; equal subtrees of any of them are one node."""

    def __init__(self, counts: np.ndarray):
        rows, width = counts.shape
        full = np.full((rows, 1 << max(width - 1, 0).bit_length()), -1, np.int64)  # -1: no term.
        full[:, :width] = counts
        self.values, names = np.unique(full, return_inverse=True)
        names = names.reshape(full.shape)
        self.halves: list[tuple[np.ndarray, np.ndarray]] = []  # Of the nodes of each level, from the leaves' parents up.
        while names.shape[1] > 1:
            below = int(names.max()) + 1
            pairs, names = np.unique(names[:, ::2] * below + names[:, 1::2], return_inverse=True)
            names = names.reshape(rows, -1)
            self.halves.append((pairs // below, pairs % below))
        self.roots = names[:, 0]

    def compared(self, a: int, others: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """For each of the other rows the sum over all terms of |price there - price in row a|."""
        which, left, right = np.arange(len(others)), np.full(len(others), self.roots[a]), self.roots[others]
        times = np.ones(len(others), np.int64)
        for low, high in reversed(self.halves):
            which, times = np.tile(which, 2), np.tile(times, 2)
            left, right = np.append(low[left], high[left]), np.append(low[right], high[right])
            base = max(int(left.max(initial=0)), int(right.max(initial=0))) + 1
            pairs, place = np.unique((which * base + left) * base + right, return_inverse=True)
            merged = np.zeros(len(pairs), np.int64)
            np.add.at(merged, place, times)
            which, left, right, times = pairs // (base * base), pairs // base % base, pairs % base, merged
        real = self.values[left] >= 0
        which, left, right, times = which[real], left[real], right[real], times[real]
        apart = np.abs(price(self.values[left], totals[a]) - price(self.values[right], totals[others[which]]))
        sums = np.zeros(len(others), np.int64)
        np.add.at(sums, which, apart * times)
        return sums


def _compared_tiles(group: pa.Table) -> pa.Table:
    """Partial values of the pairs of two tiles of sources over one block of term ids."""
    group = group.sort_by("idx")
    first, second = group["lo"][0].as_py(), group["hi"][0].as_py()
    counts = np.zeros((group.num_rows, group["width"][0].as_py()), np.int64)
    held = group["held"].combine_chunks()
    counts[pc.list_parent_indices(held).to_numpy(), held.flatten().field("at").to_numpy()] = held.flatten().field("n").to_numpy()
    totals, tile = group["total"].to_numpy(), group["tile"].to_numpy()
    forest, source = Forest(counts), group["source"].combine_chunks()
    left, right, values = [], [], []
    for a in np.flatnonzero(tile == first).tolist():
        others = np.flatnonzero((tile == second) & (np.arange(len(tile)) > a))
        left.append(np.full(len(others), a))
        right.append(others)
        values.append(forest.compared(a, others, totals))
    left, right, values = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right, values))
    langs = pa.array([group["lang"][0].as_py()] * len(left), pa.string())
    return pa.table({"lang": langs, "source": source.take(pa.array(left)), "item": source.take(pa.array(right)),
                     "value": pa.array(values, pa.int64())})


# --- the audit --------------------------------------------------------------------------------


def _kept(counts: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, id, n, n_lang) per kept term of a group, and (lang, source, size, terms, size_lang) per group."""
    terms = counts.filter("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    terms = stored(numbered(terms, [F.col("docs").desc(), F.col("term")], "id", ["lang"],
                            keep=lambda df: stored(df, "sorted-terms")), "terms")
    held = stored(counts.select("lang", "source", "term", "n").join(
        terms.select("lang", "term", F.col("id") - 1, "n_lang").toDF("lang", "term", "id", "n_lang"), ["lang", "term"]), "held")
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("size_lang"))
    groups = counts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    return held, stored(groups.na.fill(0, ["size", "terms", "size_lang"]), "groups")


def _total(size: str) -> Column:
    return F.col(size) + SMOOTHING * F.col("terms")


def _price(count: str, size: str) -> Column:
    share = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (F.col(count) + SMOOTHING).cast("decimal(20,0)"),
                            _total(size).cast("decimal(20,0)"))
    return share + 1


def source_distances(held: DataFrame, groups: DataFrame, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(lang, source, item, value) for each pair of sources of a language, once, source before item."""
    block_of = lambda col: F.call_function("div", F.col(col), F.lit(block))
    vectors = held.groupBy("lang", "source", block_of("id").alias("block")).agg(
        F.collect_list(F.struct((F.col("id") % block).cast("int").alias("at"), "n")).alias("held"))
    sources = stored(numbered(groups, [F.col("source")], "idx", ["lang"], keep=lambda df: stored(df, "sorted-sources")), "sources")
    tiles = sources.groupBy("lang").agg(F.call_function("div", F.max("idx") - 1, F.lit(tile)).alias("last_tile"))
    last_block = F.call_function("div", F.greatest(F.col("terms") - 1, F.lit(0)), F.lit(block))
    each = sources.join(tiles, "lang").select(
        "lang", "source", "idx", F.call_function("div", F.col("idx") - 1, F.lit(tile)).alias("tile"), "last_tile", "terms",
        _total("size").alias("total"), F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block"))
    full = each.join(vectors, ["lang", "source", "block"], "left").withColumn(
        "held", F.coalesce("held", F.array().cast("array<struct<at:int,n:bigint>>")))
    dealt = full.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "last_tile"))).select(
        "lang", "source", "idx", "tile", "block", "total", "held",
        F.least(F.lit(block), F.col("terms") - F.col("block") * block).alias("width"),
        F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"))
    found = dealt.groupBy("lang", "block", "lo", "hi").applyInArrow(
        _compared_tiles, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def telling_terms(held: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each term that is commoner in a source than in its language."""
    priced = held.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), (_price("n", "size") - _price("n_lang", "size_lang")).alias("value"))
    return priced.filter("value > 0")


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block: int = BLOCK,
                      tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language lies from the others, and its own terms.

    Null text, lang and source count as empty; an empty lang or source is a group like any other. A language
    whose terms all fall short of ``min_docs`` documents has pairs of value 0 and no terms. Part ``pair`` has
    all other sources, part ``term`` the first ``top_terms`` terms; equal values go by item. Repeated rows are
    documents of their own. A very long text is counted in pieces. An empty table gives no rows; doc_id and
    other columns are not read. Exact while a language has fewer than 9 * 10**15 words.
    """
    counts = stored(term_counts(docs), "term-counts")
    held, groups = _kept(counts, min_docs)
    once = stored(source_distances(held, groups, block, tile), "distances")
    pairs = once.unionByName(once.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    wanted = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    terms = ranked(telling_terms(held, groups)).filter(F.col("rank") <= top_terms)
    return wanted(ranked(pairs), "pair").unionByName(wanted(terms, "term"))
