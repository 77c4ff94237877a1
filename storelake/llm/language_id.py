"""Language identification by multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else is a word boundary; runs of 1 to 3 characters with at most one
boundary at either end are hashed into a fixed number of buckets. Training counts buckets by language on
a bounded sample of labelled rows. The log-probability matrix is broadcast (its size is bounded by
``BUCKETS`` and ``MAX_LANGUAGES``) and batches are scored as sparse sums of its rows in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.shared import slices

BUCKETS = 1 << 15
MAX_LANGUAGES = 256
TRAIN_DOCS = 20_000  # Expected size of the training sample; with fewer labelled rows all are used.
_HASHES = (1 << 63) - 1
UNDETERMINED = "und"
_CELLS = 1 << 21  # Matrix cells gathered at once.
_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])
_SALT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _letters(codes: np.ndarray) -> np.ndarray:
    known = codes < (1 << 16)
    found = _LETTER[np.where(known, codes, 0)]
    for code in np.unique(codes[~known]).tolist():
        if chr(code).isalpha():
            found |= codes == code
    return found


def _grams(text: str) -> Iterator[np.ndarray]:
    """The buckets of a whole text, in pieces of bounded size that overlap so that no n-gram is lost or doubled."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters(codes), codes, 0).astype(np.uint32)
    if not len(codes):
        return
    codes = codes[(codes != 0) | np.append(True, codes[:-1] != 0)]  # One boundary between words.
    codes = np.concatenate([[0] * bool(codes[0]), codes, [0] * bool(codes[-1])]).astype(np.uint32)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    for at in range(1, max(len(codes) - 1, 1), _CELLS):
        before, here, after = (codes[at + k:min(at + _CELLS, len(codes) - 1) + k] for k in (-1, 0, 1))
        if not len(here):
            continue
        inner = here != 0
        before, here, after = before[inner], here[inner], after[inner]
        one = here * _SALT[0]
        two = (before * _SALT[1] + one) ^ np.uint32(0x55555555)
        last = after == 0
        ending = (here[last] * _SALT[1]) ^ np.uint32(0x0F0F0F0F)
        three = (two + after * _SALT[2]) * np.uint32(0x27D4EB2F)
        for h in (one, two, ending, three):
            yield ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prior: np.ndarray  # Log shares of the training documents.
    weights: np.ndarray  # Log probabilities, a row per bucket.

    def score(self, texts: pd.Series) -> pd.DataFrame:
        """Predicted language and its posterior for each text."""
        sums = np.zeros((len(texts), max(len(self.languages), 1)))
        seen = np.zeros(len(texts), bool)
        step = max(1, _CELLS // max(len(self.languages), 1))
        strings = [t if isinstance(t, str) else "" for t in texts]
        # About three n-grams a character: texts are taken in runs whose n-grams are one step.
        for first, end in slices(np.fromiter(map(len, strings), np.int64, len(strings)), step // 3):
            rows = [np.concatenate([*_grams(t), np.zeros(0, np.int64)]) for t in strings[first:end]]
            held = [i for i, own in enumerate(rows) if len(own)]
            seen[[first + i for i in held]] = True
            if not held or not self.languages:
                continue
            if len(held) == 1:  # May be longer than a step.
                own = rows[held[0]]
                for at in range(0, len(own), step):
                    sums[first + held[0]] += self.weights[own[at:at + step]].sum(axis=0)
                continue
            starts = np.cumsum([0, *[len(rows[i]) for i in held[:-1]]])
            gathered = self.weights[np.concatenate([rows[i] for i in held])]
            sums[[first + i for i in held]] = np.add.reduceat(gathered, starts, axis=0)
        if not self.languages:
            return pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": 0.0})
        sums += self.prior
        best = sums.argmax(axis=1)
        posterior = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        names = np.array(self.languages, object)[best]
        return pd.DataFrame({"lang_pred": np.where(seen, names, UNDETERMINED), "score": np.where(seen, posterior, 0.0)})


def shares(counts: dict[str, int], train_docs: int) -> dict[str, float]:
    """The part of each language's rows to learn from, so that about ``train_docs`` rows are drawn in all.

    Languages with few rows give all of them; the others share what is left evenly, so that no language
    vanishes beside a larger one, however large the table.
    """
    left, out = train_docs, {}
    for k, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        quota = left / (len(counts) - k)
        out[lang] = min(1.0, quota / n)
        left -= min(n, quota)
    return out


def train(labelled: DataFrame, train_docs: int = TRAIN_DOCS, smoothing: float = 0.1) -> LanguageModel:
    """Learn from rows (doc_id, text, lang) with text and lang; others say nothing.

    Rows of each language are drawn by a 63-bit hash of doc_id and text; priors are the shares of all rows.
    No labelled rows give a model that calls everything undetermined. Of more than ``MAX_LANGUAGES`` values
    of lang those with the most rows are learned, ties by name.
    """
    rows = labelled.filter("text is not null and lang is not null and doc_id is not null")
    common = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    totals = {r["lang"]: r["n"] for r in common.collect()}
    if not totals:
        return LanguageModel([], np.zeros(0), np.zeros((BUCKETS, 0)))
    drawn = F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit("language")).bitwiseAND(F.lit(_HASHES))
    bounds = F.create_map(*[x for lang, share in shares(totals, train_docs).items() for x in (
        F.lit(lang), F.lit(min(int(share * _HASHES), _HASHES)).cast("long"))])
    rows = rows.filter(drawn <= bounds[F.col("lang")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                own = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                own[BUCKETS] += 1
                for grams in _grams(text):
                    own[:BUCKETS] += np.bincount(grams, minlength=BUCKETS)
        for lang, own in counts.items():
            held = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": held, "n": own[held]})

    counted = rows.select("lang", "text").mapInPandas(run, "lang string, bucket long, n long")
    # At most MAX_LANGUAGES * (BUCKETS + 1) rows.
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique().tolist())
    counts = np.zeros((BUCKETS + 1, len(languages)))
    counts[table["bucket"].to_numpy(np.int64), [languages.index(x) for x in table["lang"]]] = table["n"]
    grams, prior = counts[:BUCKETS] + smoothing, np.array([totals[lang] for lang in languages], float)
    return LanguageModel(languages, np.log(prior / prior.sum()), np.log(grams / grams.sum(axis=0)))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """A column (lang_pred, score) for ``docs``: ``und`` with score 0 where there is no letter, or nothing was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        return shared.value.score(texts)

    return scored(F.col(text))


def held_out(doc_id: Column) -> Column:
    """One document in five is never learned from, by the checksum of its id; rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def languages(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``, learned from the rows that are not held out.

    Null texts and texts without letters are ``und`` with score 0. Repeated rows get equal answers, ties go
    to the first language by name, an empty table gives no rows; other columns, whatever their names, are not
    read. A very long text is scored whole, its n-grams a bounded number at a time.
    """
    model = train(docs.filter(~held_out(F.col("doc_id"))), train_docs)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(docs, model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame, min_score: float = 0.5, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``docs`` without the rows whose language is undetermined or uncertain; all columns stay.

    Null texts and texts without letters go; repeated rows go or stay together; without labelled rows nothing
    can be told and all rows go. An empty table stays empty. Columns beside doc_id, text and lang may have any name.
    """
    model = train(docs.filter(~held_out(F.col("doc_id"))), train_docs)
    found = predict(docs, model)
    return docs.filter((found["lang_pred"] != UNDETERMINED) & (found["score"] >= min_score))
