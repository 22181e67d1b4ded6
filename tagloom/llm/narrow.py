"""Thinning a large table before it is shuffled for a join with few keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A filter is at most WORDS longs of 64 bits each, whatever the data.
WORDS = 1 << 20


def _place(*columns: Column) -> tuple[Column, Column]:
    """Word and bit of a key in the filter."""
    hashed = F.xxhash64(*columns)
    return F.pmod(hashed, F.lit(WORDS)), F.shiftrightunsigned(hashed, 58).cast("int")


def residues(keys: DataFrame, *names: str) -> DataFrame:
    """The filter of the keys: one bit for each residue of their hashes, WORDS rows at most."""
    word, bit = _place(*[F.col(n) for n in names])
    bits = keys.select(word.alias("_word"), F.call_function("shiftleft", F.expr("1L"), bit).alias("_bits"))
    return bits.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))


def possible(df: DataFrame, kept: DataFrame, *names: str, within: bool = True) -> DataFrame:
    """Rows of `df` whose key may be (within=False: cannot be) among those of `residues`.

    A pass without a shuffle. It lets through every true match and some others; the
    join proper decides. The more keys, the more it lets through: the result of the
    join never depends on it. Null keys have a residue like any other value.
    """
    how = "left_semi" if within else "left_anti"
    word, bit = _place(*[df[n] for n in names])
    is_set = kept["_bits"].bitwiseAND(F.call_function("shiftleft", F.expr("1L"), bit)) != 0
    return df.join(F.broadcast(kept), (word == kept["_word"]) & is_set, how)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
