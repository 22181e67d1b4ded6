"""Recency, frequency and money of each member, their scores and segments."""

from __future__ import annotations

import datetime

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import number_value, range_score, whole_number
from ..sources.checkpoints import checkpointed
from ..tags import dictionaries as d

SCORES = ("rencency", "frequency", "moneyTotal")


def rfm(
    orders: DataFrame, as_of: datetime.date | None = None, lag_days: int = 660
) -> DataFrame:
    """(memberId, rencency, frequency, moneyTotal) over orders of any status.

    Recency is the number of days from the last finish time to `lag_days` before
    `as_of` (today by default).
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    rows = orders.select(
        F.col("memberId").cast("string").alias("memberId"),
        F.col("orderSn"),
        number_value(orders, "orderAmount").alias("_amount"),
        whole_number(orders, "finishTime", "bigint").alias("_at"),
    )
    last = F.to_date(F.timestamp_seconds(F.max("_at")))
    return rows.groupBy("memberId").agg(
        F.datediff(F.date_sub(today, lag_days), last).alias("rencency"),
        F.count("orderSn").alias("frequency"),
        F.sum("_amount").alias("moneyTotal"),
    )


def rfm_score(measures: DataFrame, recency=None, frequency=None, money=None) -> DataFrame:
    """The three measures as scores from 1 to 5; null in the gaps between the ranges."""
    ranges = (
        recency or d.RECENCY_SCORES,
        frequency or d.FREQUENCY_SCORES,
        money or d.MONEY_SCORES,
    )
    return measures.select(
        "memberId", *[range_score(F.col(c), r).alias(c) for c, r in zip(SCORES, ranges)]
    )


def _features(scores: DataFrame) -> DataFrame:
    return VectorAssembler(
        inputCols=list(SCORES), outputCol="feature", handleInvalid="skip"
    ).transform(scores)


def _points(scores: DataFrame) -> DataFrame:
    """The distinct score triples with their numbers of members: 125 rows at most, written once."""
    counted = scores.dropna(subset=list(SCORES)).groupBy(*SCORES)
    return checkpointed(counted.agg(F.count(F.lit(1)).cast("double").alias("weight")))


def _fit(points: DataFrame, k: int, seed: int, iterations: int) -> KMeansModel:
    ordered = _features(points).repartition(1).sortWithinPartitions(*SCORES)
    return KMeans(
        k=min(k, points.count()),
        seed=seed,
        maxIter=iterations,
        featuresCol="feature",
        predictionCol="predict",
        weightCol="weight",
    ).fit(ordered)


def fit_segments(
    scores: DataFrame, k: int = 4, seed: int = 100, iterations: int = 2
) -> KMeansModel:
    """K-means over the scores of all members, of which two at least must differ.

    Three scores from 1 to 5 make at most 125 different points. Members are
    counted by point, and the counts are the weights of the fit: the same
    clusters, but the iterations run over 125 rows, and their fixed order makes
    the result independent of how the members are partitioned. There are no more
    clusters than points.
    """
    return _fit(_points(scores), k, seed, iterations)


def rfm_segments(
    scores: DataFrame, k: int = 4, seed: int = 100, iterations: int = 2
) -> DataFrame:
    """(memberId, three scores, predict); members with a null score are left out.

    Members who all have the same scores are one segment.
    """
    points = _points(scores)
    if points.count() < 2:
        return scores.dropna(subset=list(SCORES)).withColumn("predict", F.lit(0))
    return _fit(points, k, seed, iterations).transform(_features(scores)).drop("feature")
