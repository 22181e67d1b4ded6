"""Group tags from stored partial aggregates, so that a new day costs that day's rows and no rescan.

A tag over plain aggregates (`GroupTag`) needs counts, sums, maxima and minima. Each of them is kept per
group and day as a number, and numbers of different days are put together by the same kind of aggregate:
counts and sums are added, greatest values compared. What is stored for a day is replaced as a whole, so a
day may come late or again. Labels are read off the merged state by the tag's own expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grouped import GroupTag

#: Column of the day in a stored state; states are partitioned by it.
DAY = "state_day"
#: Day of rows without one, so that they count as they do in a full scan.
NO_DAY = "0001-01-01"


@dataclass(frozen=True)
class Measure:
    """One mergeable aggregate: how it is computed over rows, and how stored values are put together."""

    over_rows: Column
    merge: str  # sum, max or min

    def merged(self, name: str) -> Column:
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.merge](name)


def count_of(condition: Column | None = None) -> Measure:
    return Measure(F.count(F.lit(1)) if condition is None else F.count_if(condition), "sum")


def sum_of(value: Column) -> Measure:
    return Measure(F.sum(value), "sum")


def greatest_of(value: Column) -> Measure:
    return Measure(F.max(value), "max")


def least_of(value: Column) -> Measure:
    return Measure(F.min(value), "min")


def day_state(rows: DataFrame, key: str, day: Column, measures: Mapping[str, Measure]) -> DataFrame:
    """(key, day, measures): one row per group and day of `rows`, from partial aggregates.

    Rows without a group are left out; rows without a day are stored under NO_DAY.
    """
    keyed = rows.withColumn(DAY, F.coalesce(day, F.lit(NO_DAY).cast("date"))).where(F.col(key).isNotNull())
    return keyed.groupBy(key, DAY).agg(*[m.over_rows.alias(n) for n, m in measures.items()])


def newest_two(rows: DataFrame, key: str, day: Column, second: str) -> DataFrame:
    """(key, day, last, before): the newest and the second newest distinct second of each group and day.

    The state behind "time between the last two moments of the last day"; `before` is null where the day
    has one second. Both are aggregates with partial results: seconds are made distinct first, which spreads
    a hot group over its seconds.
    """
    keyed = rows.withColumn(DAY, day).select(key, DAY, second).where(
        F.col(key).isNotNull() & F.col(DAY).isNotNull() & F.col(second).isNotNull()
    )
    seconds = keyed.distinct()
    last = seconds.groupBy(key, DAY).agg(F.max(second).alias("last"))
    earlier = seconds.join(last, [key, DAY]).where(F.col(second) < F.col("last"))
    before = earlier.groupBy(key, DAY).agg(F.max(second).alias("before"))
    return last.join(before, [key, DAY], "left")


def store_days(state: DataFrame, path: str) -> None:
    """Write the days of `state`; each day that it holds replaces what is stored for that day.

    Only the folders of these days are written. A day that comes again with other rows, or late, is right
    after it; days that `state` does not hold stay as they are.
    """
    # Few files for a day: partitions follow the days, and a day with very many groups is split.
    writer = state.hint("rebalance", F.col(DAY)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def merged_state(state: DataFrame, key: str, measures: Mapping[str, Measure]) -> DataFrame:
    """(key, measures): one row per group over all days of `state`."""
    return state.groupBy(key).agg(*[m.merged(n).alias(n) for n, m in measures.items()])


def rolled(base: DataFrame, state: DataFrame, key: str, measures: Mapping[str, Measure]) -> DataFrame:
    """A merged state `base` after the days of `state` came in: what a nightly job reads and writes.

    `base` must not hold these days already; where a day may come again, merge from the stored days.
    """
    days = state.select(key, *measures)
    return merged_state(base.select(key, *measures).unionByName(days), key, measures)


def labelled(merged: DataFrame, key: str, tags: Sequence[GroupTag]) -> DataFrame:
    """(key as text, tags): labels read off merged measures; null where a group does not have a tag."""
    columns = []
    for tag in tags:
        label = tag.label if tag.present is None else F.when(tag.present, tag.label)
        columns.append(label.alias(tag.name))
    wide = merged.select(F.col(key).cast("string").alias(key), *columns)
    if any(tag.present is None for tag in tags):
        return wide
    return wide.where(reduce(Column.__or__, [F.col(t.name).isNotNull() for t in tags]))


def gap_from_state(state: DataFrame, key: str) -> DataFrame:
    """(key, gap) of `newest_two` states: seconds between the last two moments of the newest day."""
    newest = state.groupBy(key).agg(F.max(F.struct(F.col(DAY), "last", "before")).alias("_n"))
    gap = F.col("_n.last") - F.col("_n.before")
    return newest.select(key, gap.alias("gap")).where(F.col("gap").isNotNull())
