"""Near duplicates by SimHash: fingerprints that differ in few bits are linked, and linked documents form a group.

Search is by the generalised pigeonhole principle. The 64 bits are grouped into m partitions, correlated
bits together. If the thresholds t_i of the partitions add up to ``distance - m + 1``, any two
fingerprints within ``distance`` differ in at most t_i bits of at least one partition i. Dynamic
programming picks the thresholds that need the fewest probes and candidates, estimated from histograms
over all fingerprints, and of several numbers of partitions the cheapest is taken. Each fingerprint then probes, in each partition, all values within t_i bits of
its own, and every hit is verified on the whole 64 bits.

Scale: equal fingerprints are one node. In each bucket members are first held against one of them
(linear); the probing join then leaves out pairs that already share such a label, and verifies inside
the join, so that a crowded bucket emits links between different labels only. Statistics are counted
over all fingerprints in tables of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb
from uuid import uuid4

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.components import connected_components
from storelake.llm.shared import stored

BITS = 64
HISTOGRAM_BITS = 11  # Bits of a block whose values are counted exactly.
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 if it has no words.

    Words are runs without ASCII white space, after lower-casing A-Z. A text of fewer words than a
    shingle is one shingle. A bit is 1 if more than half of the shingles' XXH64 values have it.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return digest(joined, seed)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - words + 1].tolist()
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[words - 1:].tolist())], np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t, words, seed) for t in batch["text"]), np.uint64, len(batch))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": prints.view(np.int64)})

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {ids}, fp long")


# --- statistics over all fingerprints ---------------------------------------------------------


def _summed(nodes: DataFrame, count) -> np.ndarray:
    """Adds up, over all fingerprints, an array of fixed length that ``count`` makes of each batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            found = count(batch["fp"].to_numpy(np.int64).view(np.uint64))
            total = found if total is None else total + found
        if total is not None:
            held = np.flatnonzero(total)
            yield pd.DataFrame({"at": held, "n": total[held]})

    rows = nodes.select("fp").mapInPandas(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    size = len(count(np.zeros(0, np.uint64)))
    out = np.zeros(size, np.int64)
    for row in rows:
        out[row["at"]] = row["n"]
    return out


def _bit_matrix(values: np.ndarray) -> np.ndarray:
    octets = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little")


def _pair_counts(values: np.ndarray) -> np.ndarray:
    bits = _bit_matrix(values).astype(np.float64)
    return np.append((bits.T @ bits).astype(np.int64).ravel(), len(values))


def correlation(pair_counts: np.ndarray) -> np.ndarray:
    """Absolute correlation of every two bits, 0 where a bit never changes."""
    n = max(int(pair_counts[-1]), 1)
    both = pair_counts[:-1].reshape(BITS, BITS) / n
    mean = np.diag(both)
    spread = np.sqrt(mean * (1 - mean))
    scale = np.outer(spread, spread)
    found = np.divide(both - np.outer(mean, mean), scale, out=np.zeros_like(both), where=scale > 0)
    return np.abs(found)


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of near equal size, filled greedily with the bit most correlated with those already there."""
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        rest = sorted(free)
        group = [max(rest, key=lambda b: (corr[b, rest].sum(), -b))]
        free.discard(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def _blocks(groups: list[list[int]]) -> list[list[int]]:
    return [g[i:i + HISTOGRAM_BITS] for g in groups for i in range(0, len(g), HISTOGRAM_BITS)]


def _histograms(blocks: list[list[int]]):
    def count(values: np.ndarray) -> np.ndarray:
        bits = _bit_matrix(values).astype(np.int64)
        found = [np.bincount(bits[:, b] @ (1 << np.arange(len(b))), minlength=1 << HISTOGRAM_BITS) for b in blocks]
        return np.concatenate(found)
    return count


def _distance_shares(histogram: np.ndarray) -> np.ndarray:
    """Share of ordered pairs by their distance within a block, exact from the counts of its values."""
    width = HISTOGRAM_BITS
    spectrum = histogram.astype(np.float64)
    for k in range(width):
        pairs = spectrum.reshape(-1, 2, 1 << k)
        spectrum = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).ravel()
    spectrum = spectrum**2
    for k in range(width):
        pairs = spectrum.reshape(-1, 2, 1 << k)
        spectrum = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).ravel()
    weight = _bit_matrix(np.arange(1 << width, dtype=np.uint64)).sum(axis=1)
    shares = np.bincount(weight, np.maximum(spectrum, 0), minlength=width + 1)
    return shares / max(shares.sum(), 1)


def partition_costs(groups: list[list[int]], histograms: np.ndarray, n: int, distance: int) -> np.ndarray:
    """Estimated probes plus candidates for each partition (row) and threshold -1, 0, ... distance (column)."""
    per_block = iter(histograms.reshape(-1, 1 << HISTOGRAM_BITS))
    costs = np.zeros((len(groups), distance + 2))
    for i, group in enumerate(groups):
        shares = np.ones(1)
        for _ in range(0, len(group), HISTOGRAM_BITS):
            shares = np.convolve(shares, _distance_shares(next(per_block)))
        for t in range(distance + 1):
            probes = n * sum(comb(len(group), d) for d in range(min(t, len(group)) + 1))
            costs[i, t + 1] = probes + n * n / 2 * shares[: t + 1].sum()
    return costs


def allocate(costs: np.ndarray, distance: int) -> list[int]:
    """Thresholds (-1: the partition is not searched) that add up to distance - m + 1 at the least total cost."""
    parts = len(costs)
    goal = distance + 1  # Every threshold counted one higher.
    best = {0: (0.0, [])}
    for i in range(parts):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, goal - used):
                option = (cost + costs[i, t + 1], [*chosen, t])
                if used + t + 1 not in step or option < step[used + t + 1]:
                    step[used + t + 1] = option
        best = step
    return best[goal][1]


# --- search -----------------------------------------------------------------------------------


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _mask(bits) -> int:
    return _signed(sum(1 << b for b in bits))


def _within(mask: int, threshold: int):
    return F.bit_count(F.col("fp").bitwiseXOR(F.col("other")).bitwiseAND(F.lit(mask))) <= threshold


def plan_search(nodes: DataFrame, distance: int, parts: int | None, pairs: np.ndarray) -> list[tuple[int, list[int], int]]:
    """(partition, its bits, threshold) for each partition that is searched; without ``parts`` any number up to distance + 1."""
    corr, n = correlation(pairs), int(pairs[-1])
    options = [group_bits(corr, k) for k in ([parts] if parts else range(2, distance + 2))]
    blocks = [_blocks(groups) for groups in options]
    counted = _summed(nodes, _histograms([b for own in blocks for b in own]))  # One pass for all.
    plans, at = [], 0
    for groups, own in zip(options, blocks):
        size = len(own) << HISTOGRAM_BITS
        costs = partition_costs(groups, counted[at:at + size], n, distance)
        thresholds = allocate(costs, distance)
        total = sum(costs[i, t + 1] for i, t in enumerate(thresholds))
        plans.append((total, [(i, g, t) for i, (g, t) in enumerate(zip(groups, thresholds)) if t >= 0]))
        at += size
    return min(plans, key=lambda plan: plan[0])[1]


def near_links(nodes: DataFrame, distance: int = 4, parts: int | None = None) -> DataFrame:
    """Links (a, b) between different fingerprints at most ``distance`` bits apart.

    ``nodes`` has one row (fp) per fingerprint. Not every such pair is listed: two fingerprints linked to
    the same third one (their label) need no link of their own. The components are those of all pairs.
    """
    pairs = _summed(nodes, _pair_counts)
    n = int(pairs[-1])
    if n < 2:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    searched = plan_search(nodes, distance, parts, pairs)

    own = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("key"))
                    for i, g, _ in searched])
    index = nodes.select("fp", F.inline(own))
    # One member of each bucket is held against all others: linear, and enough for a crowded group of copies.
    least = index.groupBy("part", "key").agg(F.min("fp").alias("other"))
    held = index.join(least, ["part", "key"])
    label = F.min(F.when(_within(-1, distance), F.col("other")).otherwise(F.col("fp"))).alias("label")
    labelled = stored(held.groupBy("fp").agg(label), "labels")

    flips = [(i, _signed(sum(1 << b for b in chosen))) for i, g, t in searched
             for d in range(t + 1) for chosen in combinations(g, d)]
    masks = F.create_map(*[F.lit(x) for i, g, _ in searched for x in (i, _mask(g))])
    # The probes are data, so that their number does not lengthen the plan.
    probe_rows = F.from_json(F.lit(str([{"part": i, "flip": f} for i, f in flips]).replace("'", '"')),
                             "array<struct<part:int,flip:bigint>>")
    probes = labelled.select("fp", "label", F.inline(probe_rows)).select(
        "fp", "label", "part",
        F.col("fp").bitwiseAND(masks[F.col("part")]).bitwiseXOR(F.col("flip")).alias("key"))
    targets = labelled.select(F.col("fp").alias("other"), F.col("label").alias("other_label"),
                              F.inline(own).alias("part", "key"))
    p, t = probes.alias("p"), targets.alias("t")
    first = F.lit(False)  # A pair found in several partitions counts in the first.
    for k, (i, _, _) in enumerate(searched):
        earlier = F.lit(False)
        for _, g, limit in searched[:k]:
            earlier = earlier | _within(_mask(g), limit)
        first = first | ((F.col("p.part") == i) & ~earlier)
    hit = ((F.col("p.part") == F.col("t.part")) & (F.col("p.key") == F.col("t.key"))
           & (F.col("fp") < F.col("other")) & (F.col("label") != F.col("other_label"))
           & _within(-1, distance) & first)
    found = p.join(t, hit).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    return found.unionByName(labelled.filter("fp <> label").select(F.col("fp").alias("a"), F.col("label").alias("b")))


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, parts: int | None = None, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    component_id is the smallest doc_id that links lead to, its own included. A null text or one without
    words has fingerprint 0 and is linked like any other. Rows without doc_id count as members but lend no
    id; a group of such rows only has a null component_id. Repeated rows get equal answers; an empty table
    gives no rows; other columns, whatever their names, are not read. Very long texts are hashed whole.
    ``parts`` fixes the number of partitions; ``distance`` must be at least ``parts - 1``.
    """
    prints = stored(fingerprints(docs, words, seed), "fingerprints")
    nodes = stored(prints.select("fp").distinct(), "nodes")
    roots = connected_components(near_links(nodes, distance, parts)).select(F.col("node").alias("fp"), "root")
    rooted = stored(prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    # Written, so that the join shuffles both sides for itself and a large group can be split.
    ids = stored(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return rooted.join(ids, "root").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 4, distance: int = 4, parts: int | None = None) -> DataFrame:
    """``docs`` with one document of each group, that with the smallest doc_id; all columns stay.

    Rows without doc_id cannot be told apart and are kept. Of rows that repeat a doc_id and its text, one stays.
    Where texts share a doc_id, each goes or stays with its own group.
    """
    found = stored(near_duplicates(docs, words, distance, parts), "groups")
    goes = F.col("component_id") != F.col("doc_id")
    rows = found.groupBy("doc_id").agg(F.count_if(goes).alias("gone"), F.count_if(~goes).alias("here"))
    ids = stored(rows.filter("gone > 0 or here > 1"), "ids")
    kept = docs.join(ids.filter("gone > 0 and here = 0").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    mixed = ids.filter("gone > 0 and here > 0").select("doc_id")
    if not mixed.isEmpty():
        @F.pandas_udf("string")
        def printed(texts: pd.Series) -> pd.Series:
            return pd.Series([f"{int(fingerprint(t, words, 42)):016x}" for t in texts], dtype=object)

        own = f"fingerprint_{uuid4().hex}"
        pairs = found.filter(goes).select("doc_id", F.col("fingerprint").alias(own)).distinct()
        shared = kept.join(mixed, "doc_id", "left_semi").select(*docs.columns, printed("text").alias(own))
        shared = shared.join(pairs, ["doc_id", own], "left_anti").select(*docs.columns)
        kept = kept.join(mixed, "doc_id", "left_anti").select(*docs.columns).unionByName(shared)
    repeated = ids.filter("here > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    again = stored(repeated, "repeated")
    mark = f"text_{uuid4().hex}"
    once = kept.join(again, "doc_id", "left_semi").select(*docs.columns, F.xxhash64("text").alias(mark))
    once = once.dropDuplicates(["doc_id", mark]).select(*docs.columns)
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once)
