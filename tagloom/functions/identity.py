"""How a log row or an order is attributed to a user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .casting import whole_number


def member_user(df: DataFrame, name: str = "memberId", modulus: int = 1000) -> Column:
    """User of an order: the member number modulo 1000."""
    return whole_number(df, name) % F.lit(modulus)


def member_tail_user(df: DataFrame, name: str = "memberId", digits: int = 3) -> Column:
    """User of an order: the last three characters of the member number."""
    text = F.col(name).cast("string")
    return F.substring(text, -digits, digits).try_cast("int")


def within(df: DataFrame, known: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Rows whose user is in `known` (a table of users with a column id); `None` only drops nulls."""
    rows = df.where(F.col(key).isNotNull())
    if known is None:
        return rows
    ids = known.select(whole_number(known, "id", "bigint").alias("_known")).distinct()
    return rows.join(ids, F.col(key).cast("bigint") == F.col("_known"), "left_semi")
