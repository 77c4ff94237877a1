"""Small tables with awkward rows, shared by the tests of the text operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(docs: DataFrame) -> DataFrame:
    """The documents with more columns, named like those that operators make."""
    names = ("block", "name", "level", "n", "pos", "h", "fp", "root", "label", "size", "cell", "part", "rank", "shard", "slot",
             "tokens", "mix_epoch", "hits", "base", "added", "spans", "lang_pred", "score", "found", "row", "kept")
    return docs.selectExpr("*", *[f"'x' AS {n}" for n in names])


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"{'bcdfglmnprst'[k % 12]}{'aeiou'[k % 5]}{'lmnrst'[k % 6]}{k % 37 and 'a' or 'o'}{'bdgk'[k % 4]}"
                    for k in (pick.randrange(vocabulary) for _ in range(words)))


def by_id(df: DataFrame) -> dict:
    return {row["doc_id"]: row for row in df.collect()}
