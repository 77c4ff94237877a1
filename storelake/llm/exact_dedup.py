"""Exact duplicates by deterministic block naming.

Each text, with A-Z lower-cased, is cut into blocks of a fixed number of bytes. Equal blocks get one
integer name: distinct blocks are sorted and numbered. Then adjacent pairs of names are named in the same
way, level by level, until each document has a single name. Names stand for content and not for a hash
of it, so two documents share their last name (and level) only if their texts are equal.

Scale: blocks travel once, to be sorted, and repeated ones are merged before that. Afterwards only
numbers move. A block joins its name by a 64-bit hash; where two different blocks share a hash, both are
named and joined by content instead. A level halves the names, so there are few. Documents finished at
one level leave the loop, and every level is written to the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.shared import stored

BLOCK_BYTES = 2048
NO_PARTNER = -1  # Second of a pair at the odd end of a document.


def _cut(docs: DataFrame, block_bytes: int, hash_bits: int, content: bool) -> DataFrame:
    """A row per block: (doc_id, mark, n, pos, h), with the block, or else the text's SHA-256 in the first.

    ``mark`` keeps apart different texts under one doc_id.
    """
    keep = (1 << hash_bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, marks, counts, places, hashes, last = [], [], [], [], [], []
            for row, raw in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                text = (raw or b"").lower()
                blocks = [text[i:i + block_bytes] for i in range(0, len(text), block_bytes)] or [b""]
                mark = xxhash.xxh64_intdigest(text, 7) - (1 << 63)
                source += [row] * len(blocks)
                marks += [mark] * len(blocks)
                counts += [len(blocks)] * len(blocks)
                places += range(len(blocks))
                hashes += [(xxhash.xxh64_intdigest(b) & keep) - (1 << 63) for b in blocks]
                last += blocks if content else [hashlib.sha256(text).hexdigest(), *[None] * (len(blocks) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int64())), pa.array(marks, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(places, pa.int64()), pa.array(hashes, pa.int64()),
                 pa.array(last, pa.binary() if content else pa.string())],
                names=["doc_id", "mark", "n", "pos", "h", "block" if content else "text_sha256"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    tail = "block binary" if content else "text_sha256 string"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {ids}, mark long, n long, pos long, h long, {tail}")


def _named(things: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys, each with an integer: its place in the sorted order of its partition, after all earlier ones."""
    # groupBy merges repeated keys map-side; distinct things are spread by all their keys.
    distinct = things.groupBy(*keys).agg(F.count("*").alias("times"))
    return distinct.sortWithinPartitions(*keys).select(*keys, F.monotonically_increasing_id().alias("name"))


def _first_names(docs: DataFrame, block_bytes: int, hash_bits: int) -> tuple[DataFrame, DataFrame]:
    """The blocks as (doc_id, mark, n, pos, name) and the documents as (doc_id, mark, text_sha256, times)."""
    blocks = _cut(docs, block_bytes, hash_bits, content=True)
    names = stored(_named(blocks, ["block", "h"]).select("h", "name"), "block-names")
    slim = stored(_cut(docs, block_bytes, hash_bits, content=False), "blocks")
    shared = names.groupBy("h").agg(F.count("*").alias("times")).filter("times > 1").select("h")
    wanted = ["doc_id", "mark", "n", "pos", "name"]
    if shared.isEmpty():
        named = slim.join(names, "h").select(*wanted)
    else:
        several = stored(shared, "shared-hashes")
        plain = slim.join(names.join(several, "h", "left_anti"), "h").select(*wanted)
        unclear = blocks.join(several, "h", "left_semi")
        # Negative numbers are free; NO_PARTNER stays so.
        by_content = _named(unclear, ["block"]).withColumn("name", -2 - F.col("name"))
        named = plain.unionByName(unclear.join(by_content, "block").select(*wanted))
    texts = slim.filter("pos = 0").groupBy("doc_id", "mark", "text_sha256").agg(F.count("*").alias("times"))
    return stored(named, "level"), texts


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, level, name) per text, and the texts as (doc_id, mark, text_sha256, times)."""
    current, texts = _first_names(docs, block_bytes, hash_bits)
    done, level = [], 0
    while True:
        done.append(current.filter("n = 1").select("doc_id", "mark", F.lit(level).alias("level"), "name").distinct())
        rest = current.filter("n > 1")
        if rest.isEmpty():
            break
        side = F.col("pos") % 2
        pairs = rest.groupBy("doc_id", "mark", "n", F.floor(F.col("pos") / 2).alias("place")).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(NO_PARTNER)).alias("right"))
        named = pairs.join(_named(pairs, ["left", "right"]), ["left", "right"])
        level += 1
        current = stored(named.select("doc_id", "mark", F.ceil(F.col("n") / 2).alias("n"),
                                      F.col("place").alias("pos"), "name"), "level")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found, texts


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per row of ``docs``.

    Null text counts as empty. keep_id is the largest doc_id of the group (null if none has one) and only
    that row is kept; of rows that repeat it, exactly one. Rows without doc_id are kept only where their
    group has none, one of them. An empty table gives no rows; other columns, whatever their names, are not read. A
    very long text is cut into as many blocks as it needs and named like any other. ``hash_bits``
    narrows the hash by which blocks find their names, for tests: results don't depend on it.
    """
    found, texts = identities(docs, block_bytes, hash_bits)
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))
    rows = texts.join(found.withColumnsRenamed({"doc_id": "d", "mark": "m"}), same)
    rows = stored(rows.select("doc_id", "text_sha256", "times", "level", "name"), "identities")
    # Written, so that the join shuffles both sides for itself and a large group can be split.
    groups = stored(rows.groupBy("level", "name").agg(
        F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size")), "groups")
    copies = F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")
    each = rows.join(groups, ["level", "name"]).select("*", copies)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return each.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")
