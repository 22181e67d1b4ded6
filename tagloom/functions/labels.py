"""Label expressions. A null operand satisfies no condition, so it gets the default."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _chain(cases: Sequence[tuple[Column, Column]], default: Column) -> Column:
    if not cases:
        return default
    head, *tail = cases
    expr = F.when(*head)
    for condition, value in tail:
        expr = expr.when(condition, value)
    return expr.otherwise(default)


def code_label(code: Column, labels: Mapping, default) -> Column:
    """Label of `code` by exact equality with the keys of `labels`."""
    return _chain([(code == F.lit(k), F.lit(v)) for k, v in labels.items()], F.lit(default))


def band(
    value: Column,
    cutoffs: Sequence[tuple[float, str]],
    default: str,
    strict: bool = False,
) -> Column:
    """Label of the first cut-off that `value` reaches (exceeds, when `strict`).

    `cutoffs` runs from the highest to the lowest.
    """
    def reached(cut):
        return value > F.lit(cut) if strict else value >= F.lit(cut)

    return _chain([(reached(c), F.lit(v)) for c, v in cutoffs], F.lit(default))


def range_score(
    value: Column, ranges: Sequence[tuple[float | None, float | None, int]]
) -> Column:
    """Score of the closed range that holds `value`; null in a gap."""
    def inside(low, high):
        tests = []
        if low is not None:
            tests.append(value >= F.lit(low))
        if high is not None:
            tests.append(value <= F.lit(high))
        return reduce(Column.__and__, tests)

    return _chain(
        [(inside(low, high), F.lit(score)) for low, high, score in ranges],
        F.lit(None).cast("int"),
    )


def any_like(text: Column, patterns: Sequence[str]) -> Column:
    """True where `text` matches any LIKE pattern; case matters."""
    return reduce(Column.__or__, [text.like(p) for p in patterns])


def first_like(text: Column, labels: Sequence[tuple[str, str]]) -> Column:
    """Label of the first LIKE pattern that `text` matches, else null."""
    return _chain([(text.like(p), F.lit(v)) for p, v in labels], F.lit(None).cast("string"))


def first_max(values: Sequence[tuple[str, Column]]) -> Column:
    """Name of the greatest value; the earliest listed one wins a tie."""
    top = F.greatest(*[v for _, v in values])
    return _chain([(v == top, F.lit(name)) for name, v in values], F.lit(None).cast("string"))
