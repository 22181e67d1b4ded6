"""Casts that turn bad text into null under ANSI mode.

Columns that already have the wanted kind of type are returned untouched, so a
filter on them still reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-M-d"


def _type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def whole_number(df: DataFrame, name: str, kind: str = "int") -> Column:
    """`name` as an integer of type `kind`; integral columns keep their type."""
    if isinstance(_type(df, name), T.IntegralType):
        return F.col(name)
    return F.col(name).try_cast(kind)


def whole_amount(df: DataFrame, name: str) -> Column:
    """`name` as an int with the fraction cut off, also for decimal text."""
    value = F.col(name)
    if isinstance(_type(df, name), T.StringType):
        # The decimal parse runs only where the plain integer parse gave null.
        return F.coalesce(
            value.try_cast("int"), value.try_cast("decimal(38,6)").try_cast("int")
        )
    return value.try_cast("int")


def number_value(df: DataFrame, name: str) -> Column:
    """`name` as a double."""
    return F.col(name).try_cast("double")


def timestamp_value(df: DataFrame, name: str, fmt: str = STAMP_FORMAT) -> Column:
    """`name` as a timestamp; text that does not match `fmt` becomes null."""
    if isinstance(_type(df, name), T.StringType):
        return F.try_to_timestamp(F.col(name), F.lit(fmt))
    return F.col(name)


def epoch_seconds(df: DataFrame, name: str, fmt: str = STAMP_FORMAT) -> Column:
    """`name` as whole epoch seconds (bigint)."""
    return F.unix_timestamp(timestamp_value(df, name, fmt))


def calendar_date(df: DataFrame, name: str) -> Column:
    """`name` as a date; a time of day after the date is ignored."""
    if isinstance(_type(df, name), T.StringType):
        day = F.substring_index(F.col(name), " ", 1)
        return F.to_date(F.try_to_timestamp(day, F.lit(DAY_FORMAT)))
    return F.to_date(F.col(name))
