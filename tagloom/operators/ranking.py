"""Top value, latest rows and longest text of a group, without ranking raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, _n): how often each value occurs; a null value counts 0."""
    return df.groupBy(key, value).agg(F.count(value).alias("_n"))


def best_value(value: str, ascending: bool = False) -> Column:
    """Aggregate over `value_counts`: the most (least) frequent value, as a struct.

    Ties go to the smaller value, null last.
    """
    rank = F.col("_n") if ascending else -F.col("_n")
    missing = F.col(value).isNull()
    return F.min(
        F.struct(rank.alias("rank"), missing.alias("missing"), F.col(value).alias("value"))
    )


def top_value(
    df: DataFrame, key: str, value: str, ascending: bool = False, count_as: str = "n"
) -> DataFrame:
    """Most (or least) frequent `value` of each `key`: (key, value, count).

    The rows are counted by (key, value) first, which spreads a hot key over its
    values, and the best of the counts is again a map-side combinable aggregate.
    """
    best = value_counts(df, key, value).groupBy(key).agg(
        best_value(value, ascending).alias("_best")
    )
    return best.select(
        key,
        F.col("_best.value").alias(value),
        F.abs(F.col("_best.rank")).alias(count_as),
    )


def latest_rows(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """Rows at the greatest `stamp` of their `key`; ties are kept.

    The maxima are one small row per key, and the join back is on key and stamp,
    so the rows of a hot key are spread by their stamps.
    """
    newest = df.groupBy(key).agg(F.max(stamp).alias(stamp))
    return df.join(newest, [key, stamp], "left_semi")


def longest_text(text: str) -> Column:
    """Aggregate: the longest `text`, cut at its first comma.

    Equally long texts are taken in order; a group without any gives an empty text.
    """
    value = F.col(text)
    order = F.when(value.isNotNull(), F.struct(-F.length(value), value))
    longest = F.substring_index(F.min_by(value, order), ",", 1)
    return F.coalesce(longest, F.lit("")).alias(text)


def top_items(df: DataFrame, user: str, item: str, rating: str, k: int) -> DataFrame:
    """The `k` best rated items of each user as a recommendation list.

    Output is shaped like a recommender's: (user, recommendations) with an array
    of (item, rating) structs in rank order. The rank filter is applied before
    the shuffle too, so at most `k` rows per user and task are moved.
    """
    ranked = Window.partitionBy(user).orderBy(F.col(rating).desc(), F.col(item).asc())
    best = (
        df.select(user, item, rating)
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= k)
    )
    entries = F.array_sort(
        F.collect_list(F.struct(F.col("_rank"), F.col(item), F.col(rating)))
    )
    return best.groupBy(user).agg(entries.alias("_list")).select(
        user,
        F.transform(
            "_list",
            lambda e: F.struct(
                e[item].cast("int").alias(item), e[rating].cast("float").alias("rating")
            ),
        ).alias("recommendations"),
    )


def metric_mean(df: DataFrame, column: str) -> DataFrame:
    """One row: how many values `column` has, their sum and their mean."""
    return df.agg(
        F.count(column).alias("n"),
        F.sum(column).alias("total"),
        F.avg(column).alias("mean"),
    )
