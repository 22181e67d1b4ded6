"""Tags that are a label over plain aggregates of one group.

Such a tag is declared once and can be computed alone or together with any
other tag over the same rows and key. Together they cost one scan and one
shuffle of partial aggregates, whose size is bounded by the number of groups and
map tasks, so a group that holds a third of all rows is no heavier to shuffle
than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GroupTag:
    """A tag over one group of rows.

    name:     output column
    measures: aggregates by name
    label:    expression over the measures
    present:  expression over the measures; where it is not true the group has no tag
    rows:     rows that can change the measures; lets a lone tag filter before grouping
    metric:   the measure shown beside the label
    """

    name: str
    measures: dict[str, Column]
    label: Column
    present: Column | None = None
    rows: Column | None = None
    metric: Column | None = field(default=None)


def _aggregate(df: DataFrame, key: str, tags: Sequence[GroupTag]) -> DataFrame:
    measures: dict[str, Column] = {}
    for tag in tags:
        measures.update(tag.measures)
    return df.groupBy(key).agg(*[c.alias(n) for n, c in measures.items()])


def group_tag(df: DataFrame, key: str, tag: GroupTag, with_metric: bool = False) -> DataFrame:
    """`tag` alone: (key as string, tag[, metric]); groups without the tag are absent."""
    rows = df if tag.rows is None else df.where(tag.rows)
    grouped = _aggregate(rows, key, [tag])
    if tag.present is not None:
        grouped = grouped.where(tag.present)
    columns = [F.col(key).cast("string").alias(key), tag.label.alias(tag.name)]
    if with_metric and tag.metric is not None:
        columns.append(tag.metric.alias("metric"))
    return grouped.select(*columns)


def group_tags(df: DataFrame, key: str, tags: Sequence[GroupTag]) -> DataFrame:
    """All `tags` in one pass; null where a group does not have a tag."""
    grouped = _aggregate(df, key, tags)
    columns = []
    for tag in tags:
        label = tag.label if tag.present is None else F.when(tag.present, tag.label)
        columns.append(label.alias(tag.name))
    wide = grouped.select(F.col(key).cast("string").alias(key), *columns)
    if any(tag.present is None for tag in tags):
        return wide
    return wide.where(reduce(Column.__or__, [F.col(t.name).isNotNull() for t in tags]))


def one_per_key(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """One row per `key`, to be looked up by a join: (key, aggregates).

    Adaptive execution splits a hot partition of a join only where both sides come
    straight from a shuffle. Grouping by a digest of the key as well leaves the
    result not partitioned by the key alone, so the join shuffles these few rows
    once more, and the rows that look them up may be split.
    """
    grouped = df.groupBy(key, F.xxhash64(key).alias("_digest")).agg(*aggregates)
    return grouped.drop("_digest")
