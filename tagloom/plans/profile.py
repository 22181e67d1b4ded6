"""The wide profile from the shop tables in one go."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import PROFILE_TAGS
from ..tags import attribute, behaviour, consumption


def merge_tags(parts: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """One row per id with the columns of all `parts`, each of which has one row per id.

    The parts are stacked, moved to their id once and grouped there: one shuffle
    and one sort however many they are, where outer joins would shuffle again and
    again. An id has at most one row per part, so no id is hot.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    tags = [c for c in stacked.columns if c != key]
    order = [c for c in PROFILE_TAGS if c in tags] + [c for c in tags if c not in PROFILE_TAGS]
    return stacked.repartition(key).groupBy(key).agg(*[F.max(c).alias(c) for c in order])


def first_by_name(products: DataFrame, name: str, key: str = "id") -> DataFrame:
    """One row per id: the first of its product names in order."""
    return products.groupBy(key).agg(F.min(name).alias(name))


def build_profile(
    users: DataFrame,
    orders: DataFrame,
    goods: DataFrame,
    logs: DataFrame,
    prefixes: DataFrame | None = None,
    extra: Sequence[DataFrame] = (),
    known: DataFrame | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Every tag of every user; `extra` holds further parts, such as preferences.

    Tags over the same rows share one pass: ten over the users, eight over the
    orders, three over the URLs and two over the times and agents of page views.
    With `staging`, a folder that all executors share, each part is written there
    before the parts are merged: a failure then costs one part and not the plan.
    """
    parts = [
        attribute.user_attributes(users),
        behaviour.last_login(users, known=known),
        behaviour.page_tags(logs, known),
        behaviour.activity_tags(logs, known),
        behaviour.browse_time(logs, known=known),
        first_by_name(behaviour.last_browsed_product(logs, goods, known=known), "productName"),
        first_by_name(behaviour.purchased_products(orders, goods, known), "purchaseName"),
        consumption.order_tags(orders, known),
        consumption.payment_mode(orders, known),
    ]
    if prefixes is not None:
        parts.append(
            attribute.mobile_regions(
                users, prefixes, {"nativePlace": "city", "nativeProvince": "province"}
            )
        )
    parts += extra
    if staging is not None:
        parts = [_staged(part, f"{staging}/part_{i}") for i, part in enumerate(parts)]
    return merge_tags(parts)


def _staged(part: DataFrame, path: str) -> DataFrame:
    part.write.mode("overwrite").parquet(path)
    return part.sparkSession.read.schema(part.schema).parquet(path)
