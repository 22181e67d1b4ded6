"""Band edges learned from the data, by sketches of a bounded size that can be merged.

A band edge is a quantile of a tag's metric. One pass over the groups fills one sketch per tag; sketches of
days or of parts of the users are merged without looking at a value again. A sketch of size k answers a
quantile with a rank error of about 2.3 / k ** 0.9 of all values (1.7 % for k = 200, 0.13 % for k = 4096),
and exactly as long as it has seen k values at most.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import band

#: Size of a sketch; some ten kilobytes, however many values it has seen.
SKETCH = 4096


def rank_error(k: int = SKETCH) -> float:
    """Share of all values by which an edge's rank may be off, at 99 % confidence."""
    return 2.296 / k**0.9021


def metric_sketches(df: DataFrame, metrics: Mapping[str, Column], by: Sequence[str] = (), k: int = SKETCH) -> DataFrame:
    """One sketch per metric, for each group of `by` where it is given; nulls are not counted.

    One pass and one shuffle of sketches for all metrics.
    """
    sketches = [F.kll_sketch_agg_double(value.cast("double"), F.lit(k)).alias(name) for name, value in metrics.items()]
    return df.groupBy(*by).agg(*sketches)


def merged_sketches(sketches: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sketches of several groups, such as days, put together."""
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(n).alias(n) for n in names])


def learned_cuts(
    sketches: DataFrame, bands: Mapping[str, Sequence[tuple[float, str]]]
) -> dict[str, list[tuple[float, str]]]:
    """Cut-offs of each tag as `band` takes them, from one row of sketches.

    `bands` maps a tag to (share, label), from the highest to the lowest: the label belongs to values from
    the quantile of that share on. A label that no value could get, because its edge is not below the one
    before it, is left out; a tag without values has no cut-offs. The edges, a handful of numbers, come to
    the driver.
    """
    columns = []
    for tag, cuts in bands.items():
        shares = F.array(*[F.lit(float(share)) for share, _ in cuts])
        some = F.kll_sketch_get_n_double(tag) > 0
        columns.append(F.when(some, F.kll_sketch_get_quantile_double(F.col(tag), shares)).alias(tag))
    row = sketches.select(*columns).first()
    learned = {}
    for tag, cuts in bands.items():
        edges: list[tuple[float, str]] = []
        for edge, (_, label) in zip(row[tag] or [], cuts):
            if not edges or edge < edges[-1][0]:
                edges.append((edge, label))
        learned[tag] = edges
    return learned


def learned_bands(
    df: DataFrame,
    key: str,
    metrics: Mapping[str, Column],
    bands: Mapping[str, Sequence[tuple[float, str]]],
    lowest: str,
    k: int = SKETCH,
) -> DataFrame:
    """(key as text, one label per metric): edges from one pass over `df`, labels from another.

    A null metric has no label; values below every edge have the label `lowest`.
    """
    cuts = learned_cuts(metric_sketches(df, metrics, k=k), bands)
    labels = []
    for tag, value in metrics.items():
        labels.append(F.when(value.isNotNull(), band(value.cast("double"), cuts[tag], lowest)).alias(tag))
    return df.select(F.col(key).cast("string").alias(key), *labels)
