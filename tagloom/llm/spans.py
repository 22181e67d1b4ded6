"""Lists of spans in plain DataFrame functions, in time that grows with the text and no faster."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements of the blocks in which a list is added up.
BLOCK = 64


def _scan(values: Column) -> Column:
    """Running totals of a short list."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))

    def add(state: Column, x: Column) -> Column:
        total = state["sum"] + x
        return F.struct(total.alias("sum"), F.concat(state["out"], F.array(total)).alias("out"))

    return F.aggregate(values, start, add, lambda s: s["out"])


def bound(value: Column, fn) -> Column:
    """fn(value), with `value` computed once however often fn names it."""
    return F.transform(F.array(value), fn)[0]


def running_totals(values: Column) -> Column:
    """Running totals of a list of ints: those of its blocks, each raised by the total of the blocks before it.

    A list that grows by one element at a time is copied each time; in blocks of a fixed size the copies
    stay small however long the list.
    """

    def blocks(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / F.lit(BLOCK)).cast("int"))
        return F.transform(numbers, lambda b: _scan(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))

    def raised(parts: Column) -> Column:
        sums = F.slice(F.transform(parts, lambda p: F.element_at(p, -1)), F.lit(1), F.size(parts) - 1)
        before = F.concat(F.array(F.lit(0)), _scan(sums))
        return F.flatten(F.zip_with(parts, before, lambda part, b: F.transform(part, lambda x: x + b)))

    def total(v: Column) -> Column:
        return F.when(F.size(v) > 0, bound(blocks(v), raised)).otherwise(F.array().cast("array<int>"))

    return bound(values, total)
