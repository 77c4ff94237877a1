"""Mixing sources to target weights by temperature.

Source token shares are raised to an exponent between 0 (all sources alike) and 1 (as they are) and
normalised. The exponent is found by bisection: the largest that reaches a target entropy, but no
smaller than what the repetition limit allows. The weights are realised as passes over the sources: each
source is a set of blocks, every pass a permutation of the blocks and of the rows in each, and the last
pass ends where the source's token budget does. The budget is what gives the source with the lowest ratio
of weight to tokens exactly one pass, so that no document is lost.

Scale: texts are read where they lie. What a row gets follows from a table with one row per source: the
number of whole passes and, for the last, the place in the permutation up to which rows belong to it.
Only rows of the one block per source in which a budget ends are ranked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.shared import stored

BLOCKS = 4096  # Blocks of a source.
SECTIONS = 32  # Parts of the interval that a round of the search tells apart.
PRECISION = 1e-7  # Of the exponent.


@dataclass(frozen=True)
class Mix:
    """Target entropy as a share of that of equal weights, and the most passes over any source."""
    entropy: float = 0.97
    repetition: float = 2.0
    seed: int = 17


def tokens(text: Column) -> Column:
    """Words: runs without ASCII white space; none in a null text."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))), F.lit(0)).cast("long")


def _block(row: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(row, F.lit(f"block {seed}")), F.lit(BLOCKS)).cast("int")


def _order(what: Column, epoch: Column, seed: int) -> Column:
    """Place in the permutation of an epoch."""
    return F.xxhash64(what, epoch, F.lit(f"order {seed}"))


# --- weights ----------------------------------------------------------------------------------


def _bisect(totals: DataFrame, mix: Mix) -> float:
    """The exponent. Every round halves the interval many times over: all sections are tried in one job.

    The sources stay a table: their entropy is the logarithm of the sum of powers, less the exponent times
    the mean logarithm under the weights.
    """
    ends = totals.agg(F.max("tokens").alias("most"), F.min("tokens").alias("least"), F.count("*").alias("n")).first()
    if not ends["n"] or ends["n"] == 1 or ends["most"] == ends["least"]:
        return 1.0
    log_share = F.log(F.col("tokens") / F.lit(float(ends["most"])))

    def good(exponents: list[float]) -> list[bool]:
        tried = totals.select(log_share.alias("log"), F.posexplode(F.array(*map(F.lit, exponents))).alias("i", "a"))
        power = F.exp(F.col("log") * F.col("a"))
        sums = {r["i"]: r for r in tried.groupBy("i").agg(
            F.sum(power).alias("z"), F.sum(power * F.col("log")).alias("l")).collect()}
        return [math.log(sums[i]["z"]) - a * sums[i]["l"] / sums[i]["z"] >= mix.entropy * math.log(ends["n"])
                for i, a in enumerate(exponents)]

    low, high = 0.0, 1.0  # Entropy falls as the exponent grows; 0 reaches any target.
    if good([1.0])[0]:
        low = 1.0
    while high - low > PRECISION:
        tried = [low + (high - low) * k / SECTIONS for k in range(1, SECTIONS)]
        reached = good(tried)
        last = max((k for k, ok in enumerate(reached) if ok), default=-1)
        low, high = tried[last] if last >= 0 else low, tried[last + 1] if last + 1 < len(tried) else high
    # The smallest source is passed over (least / most) ** (exponent - 1) times for each pass over the largest.
    spread = math.log(ends["most"] / ends["least"])
    return max(low, 1 - math.log(max(mix.repetition, 1.0)) / spread, 0.0)


def weights(docs: DataFrame, mix: Mix, sizes: Column | None = None) -> tuple[DataFrame, float]:
    """(source, tokens, weight, budget, passes) per source with tokens, and the exponent.

    ``passes`` is the budget over the tokens: 1 for the largest source, more for smaller ones.
    """
    size = tokens(F.col("text")) if sizes is None else sizes
    totals = stored(docs.groupBy("source").agg(F.sum(size).alias("tokens")).filter("tokens > 0"), "sources")
    exponent = _bisect(totals, mix)
    ends = totals.agg(F.max("tokens").alias("most")).first()
    most = float(ends["most"] or 1)
    power = F.pow(F.col("tokens") / F.lit(most), F.lit(exponent))
    scale = totals.agg(F.sum(power).alias("z")).first()["z"] or 1.0
    # The largest source has weight 1 / z and its tokens as budget.
    return totals.select("source", "tokens", (power / F.lit(scale)).alias("weight"),
                         F.greatest(F.floor(power * F.lit(most)).cast("long"), "tokens").alias("budget"),
                         (power * F.lit(most) / F.col("tokens")).alias("passes")), exponent


def _cuts(slim: DataFrame, mix: Mix) -> DataFrame:
    """Per source: whole passes, and where the last one ends: before a block, and before a row of it.

    (source, weight, budget, whole, block_end, row_end): a row is in the last pass if its block comes before
    ``block_end`` in the permutation, or is that block and the row comes before ``row_end``.
    """
    rated, _ = weights(slim, mix, F.col("tokens"))
    rated = rated.withColumns({"whole": F.floor(F.col("budget") / F.col("tokens")).cast("int"),
                               "rest": F.col("budget") % F.col("tokens")})
    rated = stored(rated, "weights")
    blocks = slim.groupBy("source", "block").agg(F.sum("tokens").alias("held"))
    placed = blocks.join(rated, blocks["source"].eqNullSafe(rated["source"])).select(
        rated["source"], "block", "held", "rest", _order(F.col("block"), F.col("whole"), mix.seed).alias("at"))
    # A source has at most BLOCKS rows here.
    in_order = Window.partitionBy("source").orderBy("at", "block")
    summed = placed.withColumn("upto", F.sum("held").over(in_order))
    last = stored(summed.filter((F.col("rest") > 0) & (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("held") <= F.col("rest"))).groupBy(
        "source").agg(F.min(F.struct("at", "block", (F.col("rest") - F.col("upto") + F.col("held")).alias("left"))).alias(
            "cut")).select("source", "cut.*"), "cut-blocks")
    # Of each source the rows of one block.
    same = slim["source"].eqNullSafe(last["source"]) & (slim["block"] == last["block"])
    rows = slim.join(last, same).join(rated.select(F.col("source").alias("s"), "whole"), last["source"].eqNullSafe(F.col("s")))
    rows = rows.select(last["source"], "tokens", "left", "doc_id", _order(F.col("row"), F.col("whole"), mix.seed).alias("row_at"))
    by_row = Window.partitionBy("source").orderBy("row_at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    fits = rows.withColumn("upto", F.sum("tokens").over(by_row)).filter("upto <= left")
    ends = fits.groupBy("source").agg(F.max("row_at").alias("row_end"))
    held = last.join(ends.withColumnRenamed("source", "s"), last["source"].eqNullSafe(F.col("s")), "left").select(
        last["source"].alias("cut_source"), F.col("at").alias("block_end"), F.col("block").alias("last_block"), "row_end")
    joined = rated.join(held, rated["source"].eqNullSafe(held["cut_source"]), "left")
    return stored(joined.select("source", "weight", "budget", "tokens", "whole", "block_end", "last_block", "row_end"), "cuts")


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``docs`` once per pass, with mix_epoch, mix_weight, mix_block and mix_row as added columns.

    Within an epoch rows are in order of (mix_block, mix_row), the block's and the row's place in its
    permutation. Rows of the same place are one another's copies as far as order goes. A null source is a
    source. Null and empty texts have no tokens: they cost nothing and follow their source; a source
    without any tokens gets weight 0 and one pass. Sources of equal size get equal weights. Repeated rows
    are mixed like others, an empty table gives no rows. Columns of the same names are replaced.
    """
    own = f"mix_{uuid4().hex}_"  # Names that no column of the documents has.
    row = F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))
    inner = {own + "row": row, own + "block": _block(row, mix.seed)}
    slim = stored(docs.select("doc_id", "source", tokens(F.col("text")).alias("tokens"), row.alias("row"),
                              _block(row, mix.seed).alias("block")), "tokens")
    cuts = _cuts(slim, mix)
    renamed = cuts.select(*[F.col(c).alias(own + c) for c in cuts.columns])
    plain = [c for c in docs.columns if c not in ("mix_epoch", "mix_weight", "mix_block", "mix_row")]
    rated = docs.select(*plain).withColumns(inner).join(
        renamed.withColumnRenamed(own + "block_end", own + "end"), F.col("source").eqNullSafe(F.col(own + "source")), "left")
    whole = F.coalesce(own + "whole", F.lit(1))
    at = _order(F.col(own + "block"), whole, mix.seed)
    row_at = _order(F.col(own + "row"), whole, mix.seed)
    before = (at < F.col(own + "end")) | ((at == F.col(own + "end")) & (F.col(own + "block") < F.col(own + "last_block")))
    partly = F.coalesce(before | ((F.col(own + "block") == F.col(own + "last_block")) & (row_at <= F.col(own + "row_end"))),
                        F.lit(False))
    epochs = F.explode(F.sequence(F.lit(0), whole + partly.cast("int") - 1)).alias("mix_epoch")
    each = rated.select("*", epochs)
    return each.select(*plain, "mix_epoch", F.coalesce(own + "weight", F.lit(0.0)).alias("mix_weight"),
                       _order(F.col(own + "block"), F.col("mix_epoch"), mix.seed).alias("mix_block"),
                       _order(F.col(own + "row"), F.col("mix_epoch"), mix.seed).alias("mix_row"))


def mix_plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(doc_id, source, epoch, weight, block_order, row_order) per row and pass, without the texts."""
    found = mixed(docs.select("doc_id", "source", "text"), mix)
    return found.select("doc_id", "source", F.col("mix_epoch").alias("epoch"), F.col("mix_weight").alias("weight"),
                        F.col("mix_block").alias("block_order"), F.col("mix_row").alias("row_order"))


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``docs`` repeated as the mix wants, with their own columns only, whatever their names.

    Null and empty texts and repeated rows come as often as their source's passes say; an empty table stays empty.
    """
    return mixed(docs, mix).select(*docs.columns)
