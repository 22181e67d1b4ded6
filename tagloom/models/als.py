"""Preference models: implicit matrix factorisation and its recommendation lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import code_label
from ..sources.checkpoints import checkpointed
from ..tags import dictionaries as d


#: Blocks of users and items, whatever the cluster.
BLOCKS = 10


def fit_als(
    ratings: DataFrame,
    item: str,
    seed: int = 0,
    blocks: int = BLOCKS,
    checkpoint: bool = True,
) -> ALSModel:
    """Implicit factorisation of (userId, item, rating).

    The ratings are written once to the shared checkpoint folder, so that a lost
    executor does not send the iterations back to the logs. `blocks` is the
    number of user and item blocks. Factors start from random values per block, so the
    model depends on it, and on nothing of the session: raise it with the ratings.
    """
    rows = ratings.select("userId", item, F.col("rating").cast("float").alias("rating"))
    rows = rows.dropna()
    if checkpoint:
        rows = checkpointed(rows)
    als = ALS(
        userCol="userId",
        itemCol=item,
        ratingCol="rating",
        rank=10,
        maxIter=10,
        regParam=1.0,
        alpha=10.0,
        implicitPrefs=True,
        coldStartStrategy="drop",
        seed=seed,
    ).setPredictionCol("predict")
    return als.setNumBlocks(blocks).fit(rows)


def save_model(model: ALSModel, path: str) -> None:
    """Write `model` to `path`, replacing a model that lies there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    """The model at `path`.

    The factor tables of a loaded model are files of a known size, so Spark
    broadcasts the item side of a recommendation where it is small enough. A
    model fresh from the fit has no sizes, and every pair of its partitions is
    made a task.
    """
    return ALSModel.load(path).setPredictionCol("predict")


def fit_saved(ratings: DataFrame, item: str, path: str, seed: int = 0) -> ALSModel:
    """Fit, write to `path` and load again."""
    save_model(fit_als(ratings, item, seed), path)
    return load_model(path)


def als_rmse(model: ALSModel, test: DataFrame) -> DataFrame:
    """One row: test ratings that got a prediction, and the RMSE of the predictions."""
    error = F.col("rating").cast("double") - F.col("predict").cast("double")
    return model.transform(test).agg(
        F.count(F.lit(1)).alias("predictions"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def recommend(model: ALSModel, k: int) -> DataFrame:
    """The `k` best items of every user: (userId, recommendations).

    Every user is scored against every item. Take a loaded model; see `load_model`.
    """
    return model.recommendForAllUsers(k)


def recs_to_csv(recs: DataFrame, item: str, name: str) -> DataFrame:
    """(id, name): item ids of each recommendation list, comma-joined in rank order."""
    ids = F.transform("recommendations", lambda r: r[item].cast("string"))
    return recs.select(
        F.col("userId").cast("bigint").alias("id"), F.concat_ws(",", ids).alias(name)
    )


def explode_slots(recs: DataFrame, item: str, k: int, prefix: str) -> DataFrame:
    """(id, prefix_0 … prefix_{k-1}): one item id per column, null beyond the list's end."""
    return recs.select(
        F.col("userId").cast("string").alias("id"),
        *[
            F.get("recommendations", F.lit(i))[item].alias(f"{prefix}_{i}")
            for i in range(k)
        ],
    )


def csv_slots(rows: DataFrame, column: str, k: int, prefix: str) -> DataFrame:
    """`rows` with its comma-joined `column` taken apart into `k` columns."""
    parts = F.split(F.col(column), ",")
    slots = {f"{prefix}_{i}": F.get(parts, F.lit(i)) for i in range(k)}
    return rows.withColumns(slots).drop(column)


def label_slots(
    slots: DataFrame, labels: Mapping[int, str], default: str = d.OTHER
) -> DataFrame:
    """`slots` with the item id of every slot replaced by its label."""
    return slots.select(
        "id",
        *[
            code_label(F.col(c).try_cast("int"), labels, default).alias(c)
            for c in slots.columns
            if c != "id"
        ],
    )


def favor_brands(recs: DataFrame, k: int = 2) -> DataFrame:
    """(id, favorBrand_0 …): labels of the recommended brands."""
    return label_slots(explode_slots(recs, "brandId", k, "favorBrand"), d.BRANDS)


def favor_types(recs: DataFrame, k: int = 10) -> DataFrame:
    """(id, favorType_0 …): labels of the recommended categories."""
    labels = {code: name for name, code in d.CATEGORIES.items()}
    return label_slots(explode_slots(recs, "productType", k, "favorType"), labels)


def favor_products(recs: DataFrame) -> DataFrame:
    """(id, favorProducts): recommended product ids; the id is text, as in the profile."""
    lists = recs_to_csv(recs, "productId", "favorProducts")
    return lists.select(F.col("id").cast("string").alias("id"), "favorProducts")


def label_histogram(df: DataFrame, column: str) -> DataFrame:
    """How many rows have each value of `column`."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
