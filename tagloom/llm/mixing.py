"""Mixing sources to tempered weights (operator 7)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch

#: Most epochs of a source for one of the source that is repeated least.
REPETITION_LIMIT = 1.5
#: Tokens of a block, the unit that is permuted and cut to its budget.
BLOCK_TOKENS = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def temperature(totals: DataFrame, entropy: float | None, repetition: float | None) -> float:
    """The exponent in 0..1 that meets the targets, by bisection on a grid; 1 without a target.

    Weights grow more even as the exponent falls, and small sources are repeated more. An entropy target
    takes the greatest exponent that meets it, a repetition limit the smallest that keeps within it. With both the
    greater of the two is taken: the limit holds, and the entropy as far as the limit lets it.

    Each round evaluates 32 exponents in one aggregate over the sources, so any number of sources does.
    entropy: least entropy of the weights in nats (beyond that of equal weights: 0 is taken).
    repetition: most times a source is repeated relative to the one repeated least.
    """
    found = [] if entropy is None else [_edge(totals, lambda z, plogp, _: math.log(z) - plogp / z >= entropy - 1e-12, True)]
    if repetition is not None:
        found.append(_edge(totals, lambda z, plogp, ratio: ratio <= repetition * (1 + 1e-12), False))
    return max(found, default=1.0)


def _edge(totals: DataFrame, met: Callable[[float, float, float], bool], greatest: bool) -> float:
    """The greatest exponent that meets what holds up to some exponent, or the smallest that meets what holds from one on."""
    low, high = 0.0, 1.0
    for _ in range(4):
        grid = [low + (high - low) * i / 32 for i in range(33)]
        columns = []
        for a in grid:
            p = F.pow("share", F.lit(a))
            columns += [F.sum(p), F.sum(p * F.log(p)), F.max(F.pow("share", F.lit(a - 1))), F.min(F.pow("share", F.lit(a - 1)))]
        got = totals.agg(*columns).first()
        if got[0] is None:
            return 1.0
        good = [met(z, plogp, most / least) for z, plogp, most, least in (got[4 * i : 4 * i + 4] for i in range(33))]
        if greatest:
            last = max((i for i in range(33) if good[i]), default=0)
            if last == 32:
                return grid[32]
            low, high = grid[last], grid[last + 1]
        else:
            first = min((i for i in range(33) if good[i]), default=32)
            if first == 0:
                return grid[0]
            low, high = grid[first - 1], grid[first]
    return low if greatest else high


def mixed(
    docs: DataFrame,
    entropy: float | None = None,
    repetition: float | None = REPETITION_LIMIT,
    budget_tokens: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """The rows of `docs` as often as the mixture takes them, with _mix: n_tokens, epochs, copy, block.

    Weights are the sources' token shares to a power, normalised. budget_tokens: size of the mixture; by default the
    least with which every source is taken once at least. Each source is dealt into blocks of about
    block_tokens by hash; a block gives each document the whole epochs of its source, and one more to
    the first of a permutation while the rest of the block's budget lasts.

    Tokens are words; documents without words (null, empty) weigh nothing and are
    taken once. A null source is a source of its own, apart from the empty one. Repeated rows are dealt like others.
    A column of `docs` called _mix is
    replaced. An empty table gives no rows.
    """
    # The row travels as one value, so that no name of its columns is in the way.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "_mix"])
    words = F.regexp_count(F.col("text").cast("string"), F.lit(WORD))
    counted = docs.select(row.alias("_row"), F.coalesce(words, F.lit(0)).cast("long").alias("_tokens"))
    # The source as a key that is never null.
    key = F.coalesce(F.concat(F.lit("s"), F.col("_row.source").cast("string")), F.lit("null"))
    counted = counted.withColumn("_source", key)
    scratch = Scratch(docs.sparkSession, "mixing")
    totals = counted.where("_tokens > 0").groupBy("_source").agg(F.sum("_tokens").alias("total"))
    totals = scratch.keep(totals)
    whole = totals.agg(F.sum("total")).first()[0] or 0
    shares = totals.withColumn("share", F.col("total") / F.lit(float(max(whole, 1))))
    exponent = temperature(shares, entropy, repetition)
    z, least = shares.agg(F.sum(F.pow("share", F.lit(exponent))), F.min(F.pow("share", F.lit(exponent - 1)))).first()
    # Epochs of a source = budget * weight / total; the budget makes the least of them 1.
    budget = budget_tokens if budget_tokens is not None else (whole * z / least if z else 0.0)
    epochs = F.lit(budget) * F.pow("share", F.lit(exponent)) / F.lit(z or 1.0) / F.col("total")
    blocks = F.ceil(F.col("total") / F.lit(block_tokens)).cast("long")
    plan = shares.select("_source", epochs.alias("_epochs"), blocks.alias("_blocks"))
    dealt = counted.join(plan, "_source", "left").withColumn(
        "_block", F.pmod(F.xxhash64("_row.doc_id", F.lit(seed + 1), F.xxhash64("_row.text")), F.coalesce("_blocks", F.lit(1)))
    )
    # Documents without words, or whose source has none, are taken once, outside the blocks.
    taken = (F.col("_tokens") > 0) & F.col("_epochs").isNotNull()
    order = [F.xxhash64("_row.doc_id", F.lit(seed)), F.col("_row.doc_id"), F.xxhash64("_row.text")]
    in_block = Window.partitionBy("_source", "_block")
    before = F.sum("_tokens").over(in_block.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    full = F.floor(F.col("_epochs") + F.lit(1e-9))
    part = F.greatest(F.col("_epochs") - full, F.lit(0.0)) * F.sum("_tokens").over(in_block)
    ranked = dealt.where(taken).withColumn("_before", F.coalesce(before, F.lit(0))).withColumn("_rest", part)
    more = F.when(F.col("_before") + F.col("_tokens") / 2 <= F.col("_rest"), 1).otherwise(0)
    ranked = ranked.withColumn("_copies", (full + more).cast("int"))
    rest = dealt.where(~taken).withColumn("_copies", F.lit(1))
    kept = ["_row", "_tokens", "_epochs", "_block", "_copies"]
    both = ranked.select(kept).unionByName(rest.select(kept)).where("_copies > 0")
    return both.select("*", F.explode(F.sequence(F.lit(1), "_copies")).alias("_copy")).select(
        "_row.*",
        F.struct(
            F.col("_tokens").alias("n_tokens"),
            F.col("_epochs").alias("epochs"),
            F.col("_copy").alias("copy"),
            F.col("_block").alias("block"),
        ).alias("_mix"),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, n_tokens, epochs, copy, block: one row per document and copy."""
    found = mixed(docs.select("doc_id", "source", "text"), **options)
    return found.select("doc_id", "source", "_mix.*")
