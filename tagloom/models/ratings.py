"""Implicit ratings from product page views.

A rating is a number of views. Views are reduced to one row per user and
product, and goods to one row per product and item, before the two are joined:
repeated order lines enter as a count, never as repeated rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import code_label, product_id_from_url, whole_number
from ..tags.dictionaries import CATEGORIES, CATEGORY_OTHER


def product_ratings(logs: DataFrame) -> DataFrame:
    """Views of each product page by user: (userId, productId, rating)."""
    viewed = logs.select(
        whole_number(logs, "global_user_id").try_cast("int").alias("userId"),
        product_id_from_url(F.col("loc_url")).try_cast("int").alias("productId"),
    )
    return (
        viewed.where(F.col("productId").isNotNull())
        .groupBy("userId", "productId")
        .agg(F.count("productId").alias("rating"))
    )


def _products(goods: DataFrame, item: Column, name: str) -> DataFrame:
    """(productId, item, lines): the order lines of each product and item."""
    return (
        goods.select(whole_number(goods, "productId").alias("productId"), item.alias(name))
        .groupBy("productId", name)
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def _brand(goods: DataFrame) -> Column:
    return whole_number(goods, "brandId")


def _category(categories: Mapping[str, int] | None) -> Column:
    return code_label(
        F.col("productType"), CATEGORIES if categories is None else categories, CATEGORY_OTHER
    )


def _item_ratings(goods, logs, item, name, dedupe) -> DataFrame:
    products = _products(goods, item, name).where(F.col(name).isNotNull())
    weight = F.col("rating") if dedupe else F.col("rating") * F.col("lines")
    rated = product_ratings(logs).where(F.col("userId").isNotNull())
    return (
        rated.join(products, "productId")
        .groupBy("userId", name)
        .agg(F.sum(weight).alias("rating"))
    )


def brand_ratings(goods: DataFrame, logs: DataFrame, dedupe: bool = True) -> DataFrame:
    """Views by user and brand: (userId, brandId, rating), no nulls.

    With `dedupe=False` a view counts once for every order line of its product.
    """
    return _item_ratings(goods, logs, _brand(goods), "brandId", dedupe)


def category_ratings(
    goods: DataFrame,
    logs: DataFrame,
    dedupe: bool = True,
    categories: Mapping[str, int] | None = None,
) -> DataFrame:
    """Views by user and category code: (userId, productType, rating), no nulls."""
    return _item_ratings(goods, logs, _category(categories), "productType", dedupe)


def _rating_rows(products: DataFrame, logs: DataFrame, name: str) -> DataFrame:
    """Rated order lines, equal rows counted: (userId, item, rating, copies).

    The ratings are the left side of an inner join, which a hot product can split.
    """
    return (
        product_ratings(logs)
        .join(products, "productId")
        .groupBy("userId", name, "rating")
        .agg(F.sum("lines").alias("copies"))
    )


def brand_rating_rows(goods: DataFrame, logs: DataFrame) -> DataFrame:
    """The ratings of every order line's brand, equal rows counted: (userId, brandId, rating, copies).

    Lines of products that nobody viewed stay, with a null user and rating. They
    are added by an anti join, because the ratings of an outer join could not be
    split.
    """
    products = _products(goods, _brand(goods), "brandId")
    rated = _rating_rows(products, logs, "brandId")
    viewed = product_ratings(logs).select("productId").distinct()
    unrated = (
        products.join(viewed, "productId", "left_anti")
        .groupBy("brandId")
        .agg(F.sum("lines").alias("copies"))
    )
    return rated.unionByName(unrated, allowMissingColumns=True)


def category_rating_rows(
    goods: DataFrame, logs: DataFrame, categories: Mapping[str, int] | None = None
) -> DataFrame:
    """As `brand_rating_rows`, by category code and without unrated lines."""
    products = _products(goods, _category(categories), "productType")
    return _rating_rows(products, logs, "productType")


def in_training(item: str, share: float = 0.8, seed: int = 0, user: str = "userId") -> Column:
    """True for the `share` of ratings that belong to the training part.

    A rating's side depends only on its user, its item and `seed`, so the parts
    never overlap, whatever is recomputed and however the rows are partitioned.
    """
    text = F.concat_ws(",", F.col(user).cast("string"), F.col(item).cast("string"), F.lit(str(seed)))
    slot = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % 1000
    return slot < round(share * 1000)


def split_ratings(
    ratings: DataFrame, item: str, share: float = 0.8, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Training and test part of `ratings`.

    The two parts are read separately: pass ratings that are stored or
    checkpointed, or each part computes them again.
    """
    train = in_training(item, share, seed)
    return ratings.where(train), ratings.where(~train)
