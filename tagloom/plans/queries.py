"""Every operator as a query over the sample tables: name -> (spark, folder) -> DataFrame.

The queries keep every id, as the tags do unless told otherwise. Those named "_known" keep
the users of the users table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import last_path_segment, product_id_from_url
from ..models import als, ratings, retrieval, rfm
from ..operators import learned, metric_mean, top_items
from ..session import configure
from ..sources import (
    checkpointed,
    colocated,
    load_goods,
    load_logs,
    load_orders,
    load_users,
    profiles,
    sample,
    shared_folder,
)
from ..tags import attribute, behaviour, consumption, daily
from ..tags import dictionaries as d
from . import variants as v
from .profile import build_profile, first_by_name, merge_tags

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query; it runs with the settings the library counts on."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        return fn

    return register


def _over(name: str, source: Callable, fn: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: fn(source(spark, sf_dir)))


def _rounded(
    df: DataFrame, column: str = "metric", scale: int = 6, shift: float = 0.0
) -> DataFrame:
    """`column` rounded for comparison with SQL.

    A mean of amounts may lie half-way between two rounded values, where the order
    of the sum would decide; `shift` moves it clear of them.
    """
    return df.withColumn(column, F.round(F.col(column) + shift if shift else column, scale))


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tagloom-{uuid.uuid4().hex}"


# --- sources ---

def _loaded(name: str, source: Callable, load: Callable, fn=lambda t: t) -> None:
    """The sample table stored as the shop stores its tables, and read by the loader of the shop table."""

    def stored(spark, sf_dir):
        path = f"{_scratch(spark)}/{name}"
        source(spark, sf_dir).write.parquet(path)
        return fn(load(spark, path))

    query(name)(stored)


_loaded("read_users", sample.users, lambda spark, path: load_users(spark, path).drop("lastLoginTime"))
_loaded("read_orders", sample.orders, load_orders)
_loaded("read_goods", sample.goods, load_goods)
_loaded(
    "read_logs",
    sample.logs,
    load_logs,
    lambda t: t.withColumn("log_time", F.date_format("log_time", "yyyy-MM-dd HH:mm:ss")),
)


@query("read_orders_unified")
def _unified(spark, sf_dir):
    """Orders from two folders that store their numbers in different types."""
    folder, orders = _scratch(spark), sample.orders(spark, sf_dir)
    old = orders.where(F.col("finishTime") < F.unix_timestamp(F.lit("1995-01-01 00:00:00")))
    new = orders.where(F.col("finishTime") >= F.unix_timestamp(F.lit("1995-01-01 00:00:00")))
    narrow = {c: F.col(c).cast("int") for c in ("id", "memberId", "orderSn")}
    old.withColumns(narrow).write.parquet(f"{folder}/old")
    new.write.parquet(f"{folder}/new")
    return load_orders(spark, [f"{folder}/old", f"{folder}/new"])


@query("read_renamed")
def _renamed(spark, sf_dir):
    return sample.table(spark, sf_dir, "customer", id="c_custkey", user_agent="c_mktsegment")


@query("preview_users")
def _preview(spark, sf_dir):
    return profiles.preview(sample.users(spark, sf_dir).select("id", "job"), 10, ["id"])


# --- user attributes ---

for _tag in attribute.CODE_TAGS:
    _over(f"attr_{_tag}", sample.users, lambda t, tag=_tag: attribute.coded_tag(t, tag))
for _tag in attribute.COPIED_TAGS:
    _over(f"attr_{_tag}", sample.users, lambda t, tag=_tag: attribute.passthrough(t, tag))
_over("attr_age", sample.users, attribute.age_band)
_over("attr_constellation", sample.users, attribute.constellation)
_over("attr_all", sample.users, attribute.user_attributes)


@query("attr_nativePlace")
def _native_place(spark, sf_dir):
    return attribute.mobile_region(
        sample.users(spark, sf_dir), sample.prefixes(spark, sf_dir), "city", "nativePlace"
    )


@query("attr_nativeProvince")
def _native_province(spark, sf_dir):
    return attribute.mobile_region(
        sample.users(spark, sf_dir), sample.prefixes(spark, sf_dir), "province", "nativeProvince"
    )


@query("attr_region_longest")
def _longest_region(spark, sf_dir):
    """Regions by prefixes of several lengths; numbers are written with and without a country code."""
    parts = {"nativePlace": "city", "nativeProvince": "province"}
    return attribute.longest_prefix_regions(
        sample.users_abroad(spark, sf_dir), sample.prefixes_of_any_length(spark, sf_dir), parts
    )


# --- behaviour ---

_over("browse_frequency", sample.logs, lambda t: behaviour.browse_frequency(t, with_metric=True))
_over(
    "browse_frequency_scaled",
    sample.logs,
    lambda t: behaviour.browse_frequency(t, v.BROWSE, with_metric=True),
)
_over("login_frequency", sample.logs, lambda t: behaviour.login_frequency(t, with_metric=True))
_over(
    "login_frequency_scaled",
    sample.logs,
    lambda t: behaviour.login_frequency(t, v.LOGIN, with_metric=True),
)
_over(
    "order_page_frequency",
    sample.logs,
    lambda t: behaviour.event_frequency(
        t, "orderPageFrequency", d.ORDER_PAGES, [(15, "高"), (10, "中")], "低", with_metric=True
    ),
)
_over("page_type_counts", sample.logs, behaviour.page_type_counts)
_over("browse_period", sample.logs, lambda t: behaviour.browse_period(t, with_metric=True))
_over("browse_time", sample.logs, lambda t: behaviour.browse_time(t, with_metric=True))
_over(
    "browse_time_scaled",
    sample.logs,
    lambda t: behaviour.browse_time(t, v.GAP, with_metric=True),
)
_over("device_type", sample.logs, lambda t: behaviour.device_type(t, with_metric=True))
_over("log_tags", sample.logs, lambda t: behaviour.log_tags(t))
query("log_tags_known")(
    lambda spark, sf_dir: behaviour.log_tags(sample.logs(spark, sf_dir), known=sample.users(spark, sf_dir))
)
_over("url_browse", sample.logs, lambda t: behaviour.url_browse(t, with_metric=True))
_over(
    "url_browse_most",
    sample.logs,
    lambda t: behaviour.url_browse(t, ascending=False, with_metric=True),
)


def _users_with_login(spark, sf_dir):
    return sample.users(spark, sf_dir, last_login=True)


query("last_login_known")(
    lambda spark, sf_dir: behaviour.last_login(
        _users_with_login(spark, sf_dir), known=sample.users(spark, sf_dir), with_metric=True
    )
)
_over("last_login", _users_with_login, lambda t: behaviour.last_login(t, with_metric=True))
_over(
    "last_login_scaled",
    _users_with_login,
    lambda t: behaviour.last_login(t, with_metric=True, unit_seconds=v.LOGIN_AGE_UNIT),
)


@query("last_browsed_product")
def _last_browsed(spark, sf_dir):
    return behaviour.last_browsed_product(
        sample.logs(spark, sf_dir), sample.goods(spark, sf_dir)
    )


@query("last_browsed_product_referrer")
def _last_referred(spark, sf_dir):
    return behaviour.last_browsed_product(
        sample.logs(spark, sf_dir), sample.goods(spark, sf_dir), by="ref_url"
    )


@query("last_browsed_product_first")
def _last_browsed_first(spark, sf_dir):
    return first_by_name(_last_browsed(spark, sf_dir), "productName")


@query("purchased_products")
def _purchased(spark, sf_dir):
    return behaviour.purchased_products(
        sample.orders(spark, sf_dir), sample.goods(spark, sf_dir)
    )


@query("purchased_products_latest")
def _purchased_latest(spark, sf_dir):
    return behaviour.purchased_products(
        sample.orders(spark, sf_dir), sample.goods(spark, sf_dir), latest_only=True
    )


@query("purchased_product_list")
def _purchased_list(spark, sf_dir):
    return behaviour.purchased_product_list(
        sample.orders(spark, sf_dir), sample.goods(spark, sf_dir)
    )


@query("purchased_products_colocated")
def _colocated(spark, sf_dir):
    """The same from tables that are bucketed by order number, long orders in parts."""
    database, folder = f"tagloom_{uuid.uuid4().hex}", _scratch(spark)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/database'")
    colocated.write_colocated(
        sample.orders(spark, sf_dir), sample.goods(spark, sf_dir), database, folder, buckets=8, lines_per_part=4
    )
    lines = colocated.joined_lines(spark, database, ["memberId"], ["productId", "productName"])
    return behaviour.products_of_lines(lines)


_over("latest_orders", sample.orders, lambda t: behaviour.latest_orders(t))

# --- consumption ---

_over(
    "purchase_frequency",
    sample.orders,
    lambda t: consumption.order_frequency(t, with_metric=True),
)
_over(
    "purchase_frequency_scaled",
    sample.orders,
    lambda t: consumption.order_frequency(t, v.ORDER_COUNT, with_metric=True),
)
for _name, _measure, _bands, _scale, _shift in (
    ("consumption_power", "sum", v.POWER, 2, 0.0),
    ("order_value", "avg", v.ORDER_VALUE, 4, 1e-9),
    ("max_amount", "max", v.MAX_AMOUNT, 0, 0.0),
):
    _over(
        _name,
        sample.orders,
        lambda t, m=_measure, s=_scale, h=_shift: _rounded(
            consumption.order_amount_band(t, m, with_metric=True), scale=s, shift=h
        ),
    )
    _over(
        f"{_name}_scaled",
        sample.orders,
        lambda t, m=_measure, b=_bands, s=_scale, h=_shift: _rounded(
            consumption.order_amount_band(t, m, b, with_metric=True), scale=s, shift=h
        ),
    )
_over(
    "consumption_cycle",
    sample.orders,
    lambda t: _rounded(consumption.purchase_cycle(t, with_metric=True)),
)
_over(
    "consumption_cycle_scaled",
    sample.orders,
    lambda t: _rounded(consumption.purchase_cycle(t, v.CYCLE, with_metric=True)),
)
for _name, _status, _bands in (
    ("return_rate", d.RETURNED, v.RETURN),
    ("exchange_rate", d.EXCHANGED, v.EXCHANGE),
    ("consultation_frequency", d.CONSULTED, v.CONSULT),
):
    _over(
        _name,
        sample.orders,
        lambda t, s=_status: _rounded(consumption.status_rate(t, s, with_metric=True)),
    )
    _over(
        f"{_name}_scaled",
        sample.orders,
        lambda t, s=_status, b=_bands: _rounded(
            consumption.status_rate(t, s, b, with_metric=True)
        ),
    )
_over("order_tags", sample.orders, lambda t: consumption.order_tags(t))
query("order_tags_known")(
    lambda spark, sf_dir: consumption.order_tags(sample.orders(spark, sf_dir), known=sample.users(spark, sf_dir))
)
_over("payment_mode", sample.orders, lambda t: consumption.payment_mode(t, with_metric=True))
_over(
    "payment_mode_by_member",
    sample.orders,
    lambda t: consumption.payment_mode(t, by_member=True, with_metric=True),
)


def _mean(df: DataFrame) -> DataFrame:
    return _rounded(_rounded(metric_mean(df, "metric"), "total"), "mean")


_over(
    "mean_orders",
    sample.orders,
    lambda t: _mean(consumption.order_frequency(t, with_metric=True)),
)
for _name, _status in (
    ("mean_return_rate", d.RETURNED),
    ("mean_exchange_rate", d.EXCHANGED),
    ("mean_consultation_frequency", d.CONSULTED),
):
    _over(
        _name,
        sample.orders,
        lambda t, s=_status: _mean(
            consumption.status_rate(t, s, with_metric=True)
        ),
    )

# --- ratings and preferences ---


@query("product_id_from_url")
def _url_ids(spark, sf_dir):
    logs = sample.logs(spark, sf_dir).select("id", F.col("loc_url").alias("url"))
    pages = sample.table(spark, sf_dir, "pages", "url", id="page_id").select(
        (-F.col("id") - 1).alias("id"),
        # Page addresses have a language folder where a product address has its marker.
        F.regexp_replace("url", "/(en|de|fr|es)/", "/product/").alias("url"),
    )
    text = product_id_from_url(F.col("url"))
    return logs.unionByName(pages).select(
        "id",
        text.alias("productText"),
        text.try_cast("int").alias("productId"),
        last_path_segment(F.col("url")).alias("segment"),
    )


_over("product_ratings", sample.logs, ratings.product_ratings)


def _rating_query(name, fn):
    query(name)(
        lambda spark, sf_dir: fn(sample.goods(spark, sf_dir), sample.logs(spark, sf_dir))
    )


_rating_query("brand_ratings", ratings.brand_ratings)
_rating_query("brand_ratings_by_line", lambda g, l: ratings.brand_ratings(g, l, dedupe=False))
_rating_query("brand_rating_rows", ratings.brand_rating_rows)
_rating_query("category_ratings", ratings.category_ratings)
_rating_query(
    "category_ratings_by_line", lambda g, l: ratings.category_ratings(g, l, dedupe=False)
)
_rating_query("category_rating_rows", ratings.category_rating_rows)
_rating_query(
    "category_ratings_scaled",
    lambda g, l: ratings.category_ratings(
        g, l, categories={"ECONOMY": 1, "LARGE": 2, "SMALL": 3}
    ),
)


@query("split_ratings")
def _split(spark, sf_dir):
    rows = ratings.product_ratings(sample.logs(spark, sf_dir))
    part = F.when(ratings.in_training("productId"), "train").otherwise("test")
    return rows.withColumn("part", part)


def _top_brands(goods, logs, k):
    return top_items(ratings.brand_ratings(goods, logs), "userId", "brandId", "rating", k)


_rating_query(
    "brand_list",
    lambda g, l: als.recs_to_csv(_top_brands(g, l, 2), "brandId", "favorBrands"),
)
_rating_query("brand_slots", lambda g, l: als.favor_brands(_top_brands(g, l, 2)))
_rating_query(
    "brand_histogram",
    lambda g, l: als.label_histogram(
        als.recs_to_csv(_top_brands(g, l, 1), "brandId", "favorBrand"), "favorBrand"
    ),
)


def _top_types(goods, logs, k):
    rows = ratings.category_ratings(goods, logs)
    return top_items(rows, "userId", "productType", "rating", k)


_rating_query("type_slots", lambda g, l: als.favor_types(_top_types(g, l, 10)))


@query("type_slots_from_list")
def _type_slots_from_list(spark, sf_dir):
    recs = _top_types(sample.goods(spark, sf_dir), sample.logs(spark, sf_dir), 10)
    lists = als.recs_to_csv(recs, "productType", "favorTypes")
    return als.csv_slots(lists, "favorTypes", 10, "favorType")


def _top_products(logs, k):
    return top_items(ratings.product_ratings(logs), "userId", "productId", "rating", k)


_over("product_list", sample.logs, lambda t: als.favor_products(_top_products(t, 10)))
_rating_query(
    "preferences",
    lambda g, l: merge_tags(
        [
            als.favor_brands(_top_brands(g, l, 2)),
            als.favor_types(_top_types(g, l, 10)),
            als.favor_products(_top_products(l, 10)),
        ]
    ),
)


@query("als_rmse")
def _als_rmse(spark, sf_dir):
    rows = checkpointed(ratings.product_ratings(sample.logs(spark, sf_dir)))
    train, test = ratings.split_ratings(rows, "productId")
    return als.als_rmse(als.fit_als(train, "productId", checkpoint=False), test)


def _fitted(spark: SparkSession, rows: DataFrame, item: str):
    return als.fit_saved(rows, item, f"{_scratch(spark)}/{item}")


@query("als_favor_products")
def _als_products(spark, sf_dir):
    rows = ratings.product_ratings(sample.logs(spark, sf_dir))
    return als.favor_products(retrieval.recommend_by_norm(_fitted(spark, rows, "productId"), "productId", 10))


@query("als_favor_brands")
def _als_brands(spark, sf_dir):
    rows = ratings.brand_ratings(sample.goods(spark, sf_dir), sample.logs(spark, sf_dir))
    return als.favor_brands(retrieval.recommend_by_norm(_fitted(spark, rows, "brandId"), "brandId", 2))


@query("als_brand_histogram")
def _als_histogram(spark, sf_dir):
    rows = ratings.brand_ratings(sample.goods(spark, sf_dir), sample.logs(spark, sf_dir))
    recs = retrieval.recommend_by_norm(_fitted(spark, rows, "brandId"), "brandId", 1)
    return als.label_histogram(als.recs_to_csv(recs, "brandId", "favorBrand"), "favorBrand")


@query("als_favor_types")
def _als_types(spark, sf_dir):
    rows = ratings.category_ratings(sample.goods(spark, sf_dir), sample.logs(spark, sf_dir))
    return als.favor_types(retrieval.recommend_by_norm(_fitted(spark, rows, "productType"), "productType", 10))


# --- recency, frequency and money ---

_over("rfm", sample.orders, lambda t: _rounded(rfm.rfm(t, v.AS_OF), "moneyTotal", 2))
_over("rfm_score", sample.orders, lambda t: rfm.rfm_score(rfm.rfm(t, v.AS_OF)))


def _scores(orders: DataFrame) -> DataFrame:
    return rfm.rfm_score(rfm.rfm(orders, v.AS_OF), v.RECENCY, v.FREQUENCY, v.MONEY)


_over("rfm_score_scaled", sample.orders, _scores)
_over("rfm_segments", sample.orders, lambda t: rfm.rfm_segments(_scores(t)))

@query("rfm_segments_coverage")
def _segment_coverage(spark, sf_dir):
    """Members by score triple, and whether each triple lies in one of the four segments."""
    segments = rfm.rfm_segments(_scores(sample.orders(spark, sf_dir)))
    first, last = F.min("predict"), F.max("predict")
    return segments.groupBy(*rfm.SCORES).agg(
        F.count(F.lit(1)).alias("members"), (first == last).alias("one_segment"), ((first >= 0) & (last < 4)).alias("known")
    )


# --- models: what can be said of them without their floats ---


@query("als_coverage")
def _als_coverage(spark, sf_dir):
    """For every user how many items its list has, and whether they are distinct and in order."""
    rows = ratings.product_ratings(sample.logs(spark, sf_dir))
    lists = retrieval.recommend_by_norm(_fitted(spark, rows, "productId"), "productId", 10)
    items = F.transform("recommendations", lambda r: r["productId"])
    scores = F.transform("recommendations", lambda r: r["rating"])
    return lists.select(
        "userId",
        F.size(items).cast("long").alias("items"),
        (F.size(F.array_distinct(items)) == F.size(items)).alias("distinct_items"),
        (F.reverse(F.array_sort(scores)) == scores).alias("in_order"),
    )


@query("als_stored")
def _als_stored(spark, sf_dir):
    """A model that was saved and loaded: its users, items and rank."""
    model = _fitted(spark, ratings.product_ratings(sample.logs(spark, sf_dir)), "productId")
    users = model.userFactors.agg(F.count(F.lit(1)).alias("users"), F.max(F.size("features")).alias("rank"))
    return users.join(model.itemFactors.agg(F.count(F.lit(1)).alias("items")))


@query("als_fold_in")
def _als_fold_in(spark, sf_dir):
    """A model of the training part; every user's factors from all ratings, without another fit."""
    rows = checkpointed(ratings.product_ratings(sample.logs(spark, sf_dir)))
    train, _ = ratings.split_ratings(rows, "productId")
    users = retrieval.fold_in(_fitted(spark, train, "productId"), rows, "productId")
    finite = F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x))
    return users.select("id", F.size("features").alias("factors"), finite.alias("finite"))


@query("als_rmse_coverage")
def _als_rmse_coverage(spark, sf_dir):
    """How many held-out ratings got a prediction, and whether their error is that of a fit."""
    error = _als_rmse(spark, sf_dir)
    return error.select("predictions", F.col("rmse").between(0, 100).alias("bounded"))


# --- tags from stored days ---


@query("order_tags_stored")
def _orders_by_day(spark, sf_dir):
    """Orders stored by quarter: a part of one first, the later ones next, then that one again as a whole."""
    _store_orders(spark, sf_dir, folder := _scratch(spark))
    return daily.stored_order_tags(spark, folder)


def _store_orders(spark, sf_dir, folder):
    orders = sample.orders(spark, sf_dir)
    cut, end = (F.unix_timestamp(F.lit(f"1995-{m}-01 00:00:00")) for m in ("02", "04"))
    daily.store_orders(orders.where(F.col("finishTime") < cut), folder, "quarter")
    daily.store_orders(orders.where(F.col("finishTime") >= end), folder, "quarter")
    first = F.unix_timestamp(F.lit("1995-01-01 00:00:00"))
    daily.store_orders(orders.where(F.col("finishTime").between(first, end - 1)), folder, "quarter")


@query("rfm_stored")
def _rfm_by_day(spark, sf_dir):
    _store_orders(spark, sf_dir, folder := _scratch(spark))
    return _rounded(daily.stored_rfm(spark, folder, v.AS_OF), "moneyTotal", 2)


def _stored_views(spark, sf_dir):
    folder, logs = _scratch(spark), sample.logs(spark, sf_dir)
    daily.store_views(logs, folder)
    # A day that comes again replaces itself.
    newest = logs.agg(F.max(F.to_date("log_time"))).scalar()
    daily.store_views(logs.where(F.to_date("log_time") == newest), folder)
    return folder


query("log_tags_stored")(lambda spark, sf_dir: daily.stored_log_tags(spark, _stored_views(spark, sf_dir)))
query("browse_time_stored")(lambda spark, sf_dir: daily.stored_browse_time(spark, _stored_views(spark, sf_dir)))
query("page_type_counts_by_day")(
    lambda spark, sf_dir: daily.stored_page_type_counts(spark, _stored_views(spark, sf_dir))
)

# --- learned bands ---

_SHARES = [(0.75, "高"), (0.5, "中"), (0.25, "低")]


@query("learned_order_bands")
def _learned(spark, sf_dir):
    """Order tags with edges at the quartiles of their metrics, all learned in one pass."""
    measures = consumption.order_measures(sample.orders(spark, sf_dir))
    metrics = {
        "purchaseFrequency": F.col("orders"),
        "maxAmount": F.col("whole_max"),
        "consumptionCycle": F.col("cycle"),
    }
    return learned.learned_bands(measures, "id", metrics, {tag: _SHARES for tag in metrics}, "很低")


# --- the profile ---


def _build(spark, sf_dir, **options):
    return build_profile(
        sample.users(spark, sf_dir, last_login=True),
        sample.orders(spark, sf_dir),
        sample.goods(spark, sf_dir),
        sample.logs(spark, sf_dir),
        sample.prefixes(spark, sf_dir),
        **options,
    )


query("profile")(lambda spark, sf_dir: _build(spark, sf_dir))
query("profile_known")(
    lambda spark, sf_dir: _build(spark, sf_dir, known=sample.users(spark, sf_dir))
)
query("profile_staged")(
    lambda spark, sf_dir: _build(spark, sf_dir, staging=_scratch(spark))
)


@query("profile_with_preferences")
def _with_preferences(spark, sf_dir):
    """All columns of the profile."""
    goods, logs = sample.goods(spark, sf_dir), sample.logs(spark, sf_dir)
    preferences = [
        als.favor_brands(_top_brands(goods, logs, 2)),
        als.favor_types(_top_types(goods, logs, 10)),
        als.favor_products(_top_products(logs, 10)),
    ]
    return _build(spark, sf_dir, extra=preferences)


@query("profile_promote_many")
def _promote_many(spark, sf_dir):
    """Nine tags staged as rows, some of them twice, and promoted in one join."""
    folder, orders = f"{_scratch(spark)}/staged", sample.orders(spark, sf_dir)
    early, late = (F.lit(f"2020-01-0{i} 00:00:00").cast("timestamp") for i in (1, 2))
    finished = orders.where(F.col("orderStatus") == d.FINISHED)
    profiles.stage_tags(consumption.order_frequency(finished, v.FINISHED_COUNT), folder, late)
    profiles.stage_tags(consumption.order_tags(orders), folder, early)
    profiles.stage_tags(consumption.payment_mode(orders), folder, early)
    names = ["paymentMode", *(c for c in consumption.order_tags(orders).columns if c != "id")]
    profile = attribute.coded_tag(sample.users(spark, sf_dir), "gender")
    return profiles.promote_tags(profile, spark.read.parquet(folder), names)


@query("profile_by_range")
def _by_range(spark, sf_dir):
    """Some ids of a profile that was split by ranges of ids."""
    path = f"{_scratch(spark)}/ranged"
    profiles.write_profile_ranges(attribute.user_attributes(sample.users(spark, sf_dir)), path, ranges=8)
    return profiles.read_profile_ranges(spark, path, low="2", high="5")


@query("profile_upsert")
def _upsert(spark, sf_dir):
    """Order counts of all orders, replaced by those of finished orders where there are any."""
    orders = sample.orders(spark, sf_dir)
    profile = merge_tags(
        [
            attribute.coded_tag(sample.users(spark, sf_dir), "gender"),
            consumption.order_frequency(orders, v.ORDER_COUNT),
        ]
    )
    finished = orders.where(F.col("orderStatus") == d.FINISHED)
    changed = consumption.order_frequency(finished, v.FINISHED_COUNT)
    return profiles.upsert_tag(profile, changed, "purchaseFrequency")


@query("profile_promote")
def _promote(spark, sf_dir):
    """Stage two tags, promote both, write the profile by id and read it back."""
    folder = _scratch(spark)
    orders = sample.orders(spark, sf_dir)
    for name, status, bands in (
        ("exchangeRate", d.EXCHANGED, v.EXCHANGE),
        ("consultationFrequency", d.CONSULTED, v.CONSULT),
    ):
        profiles.stage_tag(
            consumption.status_rate(orders, status, bands), name, folder
        )
    profile = attribute.coded_tag(sample.users(spark, sf_dir), "gender")
    profile = profiles.promote_tag(spark, "exchangeRate", folder, profile)
    profile = profiles.promote_tag(spark, "consultationFrequency", folder, profile)
    profiles.write_profile(profile, f"{folder}/profile", partitions=5)
    return profiles.read_profile(
        spark, f"{folder}/profile", ["gender", "exchangeRate", "consultationFrequency"]
    )


@query("page_type_counts_staged")
def _staged_pages(spark, sf_dir):
    folder = _scratch(spark)
    counts = behaviour.page_type_counts(sample.logs(spark, sf_dir))
    profiles.stage_tag(counts, "PageBrowse", folder)
    return profiles.read_staged_tag(spark, "PageBrowse", folder)
