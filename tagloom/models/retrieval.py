"""The best items of every user from a factor model, without scoring every pair.

The score of a user and an item is the product of their factors, which is at most the product of the
lengths of the two vectors. Items are laid out by length, the longest first, in rounds: a few hundred in
the first, twice as many in each further one. A user who has k items is done as soon as the greatest length
still to come, times the user's own, cannot reach the user's k-th score: nothing further on can enter the
list. Before that, single items that cannot reach it are passed over without being scored.

Factors are laid out as columns, so that a score is plain arithmetic inside generated code.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.checkpoints import shared_folder

#: Items of the first round, and of one row in which items are sent to the tasks.
BLOCK_ITEMS = 256
#: Bytes of factors that a round sends to all tasks at most, whatever the size of the catalogue.
ROUND_BYTES = 32 << 20
#: Room left for the rounding of sums of products, relative to the product of lengths.
SLACK = 1e-9


def _norm(features: Column) -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))


def by_norm(factors: DataFrame) -> DataFrame:
    """(item, features, norm, at): items with their place `at` in the order of length, longest first.

    Lengths are counted in buckets of a fixed width of their logarithm. Items of a bucket stand behind those
    of all longer buckets; inside it they are numbered by length and id. Buckets are parted by a hash, so
    that very many similar lengths are numbered by many tasks; no bound relies on the order inside a bucket.
    """
    items = factors.select(F.col("id").alias("item"), "features", _norm(F.col("features")).alias("norm"))
    fine = F.when(F.col("norm") > 0, F.floor(-F.log2("norm") * 64)).otherwise(F.lit(1 << 30)).cast("int")
    keyed = items.withColumn("_bucket", fine).withColumn("_part", F.pmod(F.xxhash64("item"), F.lit(64)).cast("int"))
    counts = keyed.groupBy("_bucket", "_part").agg(F.count(F.lit(1)).alias("_n"))
    # Lengths are floats: some thousand buckets of 64 parts at most, whatever the catalogue.
    before = Window.orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_bucket", "_part").orderBy(F.col("norm").desc(), F.col("item"))
    placed = keyed.withColumn("_in", F.row_number().over(inside) - 1).join(offsets, ["_bucket", "_part"])
    return placed.select("item", "features", "norm", (F.col("_before") + F.col("_in")).alias("at"))


def _rounds(at: Column, first: int, most: int) -> Column:
    """Round of the item at place `at`: first, 2 first, 4 first … items, then `most` in each."""
    doublings = max(int(math.log2(max(most // first, 1))), 0)
    grown = first * (2**doublings - 1)
    early = F.floor(F.log2(at / F.lit(first) + 1))
    late = F.lit(doublings) + F.floor((at - grown) / F.lit(first * 2**doublings))
    return F.when(at < grown, early).otherwise(late).cast("int")


def _columns(features: str, rank: int, prefix: str) -> list[Column]:
    return [F.get(features, F.lit(i)).cast("double").alias(f"{prefix}{i}") for i in range(rank)]


def _score(rank: int) -> Column:
    score = F.col("u0") * F.col("v0")
    for i in range(1, rank):
        score = score + F.col(f"u{i}") * F.col(f"v{i}")
    return score


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The k best (user, item, score) of every user; ties go to the smaller item."""
    order = Window.partitionBy("user").orderBy(F.col("score").desc(), F.col("item"))
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


class _Tables:
    """Tables of the rounds, each written once below one shared folder: a lost executor costs no round."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/retrieval-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def top_items_by_norm(
    users: DataFrame, items: DataFrame, k: int, rank: int, first: int = BLOCK_ITEMS, round_bytes: int = ROUND_BYTES
) -> DataFrame:
    """(user, item, score): the k items of greatest score of every user, ties by item id.

    `users` and `items` have id and features, as the factor tables of a model have. Scores are summed in
    double. The lists are exactly those of scoring every pair; they are shorter than k only where there are
    fewer items. Without users or items there are no rows.
    """
    tables = _Tables(users)
    most = max(round_bytes // (8 * (rank + 2)), first)
    laid = by_norm(items)
    laid = tables.keep(
        laid.select("item", "norm", _rounds(F.col("at"), first, most).alias("round"), "at", *_columns("features", rank, "v"))
    )
    # One row per round: how many blocks it has and how long its longest item is.
    block = F.floor(F.col("at") / F.lit(BLOCK_ITEMS))
    heads = laid.groupBy("round").agg(F.max("norm").alias("longest"), F.min(block).alias("low"), F.max(block).alias("high"))
    heads = sorted(heads.collect())
    vector = [f"u{i}" for i in range(rank)]
    open_users = users.select(
        F.col("id").alias("user"), _norm(F.col("features")).alias("length"), *_columns("features", rank, "u")
    ).withColumn("worst", F.lit(None).cast("double"))
    best, done = None, []
    for n, head in enumerate(heads):
        own = laid.where(F.col("round") == head["round"]).withColumn("block", block)
        found = _scored(open_users, own, head.low, head.high, rank)
        best = _best(found if best is None else found.unionByName(best), k)
        if n + 1 == len(heads):
            done.append(best)
            break
        best = tables.keep(best)
        reach = F.col("length") * F.lit(max(h.longest for h in heads[n + 1 :]))
        state = best.groupBy("user").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("worst"))
        judged = tables.keep(open_users.drop("worst").join(state, "user"))
        finished = F.col("worst") > reach + F.lit(SLACK) * reach
        done.append(best.join(judged.where(finished).select("user"), "user", "left_semi"))
        open_users = judged.where(~finished | F.col("worst").isNull()).select("user", "length", *vector, "worst")
        best = best.join(open_users.select("user"), "user", "left_semi")
        if open_users.isEmpty():
            break
    if not done:
        return users.limit(0).select(F.col("id").alias("user"), F.col("id").alias("item"), F.lit(0.0).alias("score"))
    return reduce(DataFrame.unionByName, done)


def _scored(users: DataFrame, items: DataFrame, low: int, high: int, rank: int) -> DataFrame:
    """(user, item, score) of the open users and the items of a round that can reach a user's k-th score.

    Items are packed into rows of BLOCK_ITEMS. The rows of a round hold ROUND_BYTES of factors at most and
    are broadcast; users meet them by an equi-join on the number of the row.
    """
    item = F.struct("item", "norm", *[f"v{i}" for i in range(rank)])
    packed = F.broadcast(items.groupBy("block").agg(F.collect_list(item).alias("items")))
    numbers = F.explode(F.sequence(F.lit(low).cast("long"), F.lit(high).cast("long"))).alias("block")
    met = users.select("*", numbers).join(packed, "block").drop("block")
    pairs = met.select(*users.columns, F.inline("items"))
    worst = F.coalesce("worst", F.lit(float("-inf")))
    pairs = pairs.where(F.col("length") * F.col("norm") * (1 + SLACK) >= worst)
    scored = pairs.select("user", "item", _score(rank).alias("score"), worst.alias("_worst"))
    return scored.where(F.col("score") >= F.col("_worst")).drop("_worst")


def _lists(found: DataFrame, item: str) -> DataFrame:
    """(userId, recommendations) from (user, item, score): structs (item, rating) in rank order."""
    entries = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("item").alias("i"))))

    def entry(e: Column) -> Column:
        return F.struct(e["i"].cast("int").alias(item), (-e["s"]).cast("float").alias("rating"))

    lists = found.groupBy("user").agg(entries.alias("_list"))
    return lists.select(F.col("user").alias("userId"), F.transform("_list", entry).alias("recommendations"))


def recommend_by_norm(model: ALSModel, item: str, k: int) -> DataFrame:
    """(userId, recommendations), as `recommend` gives them: the k best items of every user of the model."""
    return _lists(top_items_by_norm(model.userFactors, model.itemFactors, k, model.rank), item)


def recommend_from(model: ALSModel, item: str, candidates: DataFrame, k: int) -> DataFrame:
    """The k best of each user's own candidate items: (userId, recommendations).

    `candidates` has userId and the item column; only these pairs are scored, by two equi-joins. Pairs
    whose user or item the model does not know are left out.
    """
    rank = model.rank
    users = model.userFactors.select(F.col("id").alias("user"), *_columns("features", rank, "u"))
    items = model.itemFactors.select(F.col("id").alias("item"), *_columns("features", rank, "v"))
    pairs = candidates.select(F.col("userId").alias("user"), F.col(item).alias("item")).distinct()
    scored = pairs.join(users, "user").join(items, "item").select("user", "item", _score(rank).alias("score"))
    return _lists(_best(scored, k), item)


def normal_sums(ratings: DataFrame, items: DataFrame, item: str, rank: int, alpha: float) -> DataFrame:
    """Per user the sums that implicit least squares needs: (user, a_i_j for i <= j, b_i, n).

    For a rating r the confidence is 1 + alpha |r|. The sums are those of alpha |r| v v' and, where r > 0, of
    (1 + alpha |r|) v; `n` counts the positive ratings. Plain sums: partial aggregates are shuffled, so a
    user with very many ratings is no heavier than another.
    """
    factors = items.select(F.col("id").alias(item), *_columns("features", rank, "v"))
    rows = ratings.select(F.col("userId").alias("user"), item, F.col("rating").cast("double").alias("r")).dropna()
    extra = F.lit(alpha) * F.abs(F.col("r"))
    positive = F.when(F.col("r") > 0, 1.0 + extra).otherwise(F.lit(0.0))
    v = [F.col(f"v{i}") for i in range(rank)]
    sums = [F.sum(extra * v[i] * v[j]).alias(f"a_{i}_{j}") for i in range(rank) for j in range(i, rank)]
    sums += [F.sum(positive * v[i]).alias(f"b_{i}") for i in range(rank)]
    sums.append(F.count_if(F.col("r") > 0).alias("n"))
    return rows.join(factors, item).groupBy("user").agg(*sums)


def gram_matrix(items: DataFrame, rank: int) -> list[list[float]]:
    """The rank x rank matrix of sums of v_i v_j over all items: one small row on the driver."""
    v = [F.get("features", F.lit(i)).cast("double") for i in range(rank)]
    sums = items.agg(*[F.sum(v[i] * v[j]).alias(f"g_{i}_{j}") for i in range(rank) for j in range(i, rank)]).first()
    return [[sums[f"g_{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(rank)] for i in range(rank)]


def _bound(value: Column, fn) -> Column:
    """fn(value), with `value` computed once however often fn names it."""
    return F.transform(F.array(value), fn)[0]


def _eliminated(matrix: Column, rank: int) -> Column:
    """The rows of `matrix` after Gauss-Jordan elimination: the last of each row is the solution.

    The matrix is symmetric and positive, so no pivot is looked for.
    """

    def step(rows: Column, p: Column) -> Column:
        pivot = F.get(rows, p)
        scaled = F.transform(pivot, lambda x: x / F.get(pivot, p))

        def others(unit: Column) -> Column:
            def row(own: Column, i: Column) -> Column:
                factor = F.get(own, p)
                return F.when(i == p, unit).otherwise(F.zip_with(own, unit, lambda x, y: x - factor * y))

            return F.transform(rows, row)

        return _bound(scaled, others)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rank - 1)), matrix.cast("array<array<double>>"), step)


def _solved(sums: DataFrame, gram: Sequence[Sequence[float]], rank: int, reg: float) -> DataFrame:
    """(id, features): the solution of (G + A + reg n I) x = b of every user, by array functions."""

    def cell(i: int, j: int) -> Column:
        value = F.col(f"a_{min(i, j)}_{max(i, j)}") + F.lit(float(gram[i][j]))
        return value + F.lit(reg) * F.col("n") if i == j else value

    matrix = F.array(*[F.array(*[cell(i, j) for j in range(rank)], F.col(f"b_{i}")) for i in range(rank)])
    features = F.transform(_eliminated(matrix, rank), lambda row: F.element_at(row, -1).cast("float"))
    return sums.select(F.col("user").alias("id"), features.alias("features"))


def fold_in(
    model: ALSModel, ratings: DataFrame, item: str, reg: float = 1.0, alpha: float = 10.0
) -> DataFrame:
    """(id, features): factors of the users of `ratings` from the item factors of a fitted model.

    This is the half-step of the fit that solves for users while items stay: for a user with positive
    ratings P, (V'V + sum of alpha r v v' + reg |P| I) x = sum over P of (1 + alpha r) v. Users that were
    not in the fit get factors, and those that were get the ones their present ratings call for. `reg` and
    `alpha` are those of the fit. Ratings of items that the model does not know do not count; a user without
    any other is absent.
    """
    rank = model.rank
    sums = normal_sums(ratings, model.itemFactors, item, rank, alpha).where(F.col("n") > 0)
    return _solved(sums, gram_matrix(model.itemFactors, rank), rank, reg)


def recommend_folded(model: ALSModel, ratings: DataFrame, item: str, k: int) -> DataFrame:
    """(userId, recommendations) of the users of `ratings`, known to the model or not, without a new fit."""
    users = fold_in(model, ratings, item)
    return _lists(top_items_by_norm(users, model.itemFactors, k, model.rank), item)
