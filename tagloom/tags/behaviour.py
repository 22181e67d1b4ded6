"""Tags from page views: frequency, period, device, recency and products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    any_like,
    band,
    epoch_seconds,
    first_like,
    first_max,
    last_path_segment,
    member_tail_user,
    timestamp_value,
    whole_number,
    within,
)
from ..operators import (
    GroupTag,
    best_value,
    group_tag,
    group_tags,
    last_gap,
    latest_rows,
    longest_text,
    one_per_key,
    top_value,
    value_counts,
)
from . import dictionaries as d

LOGIN_PATTERNS = (*d.LOGIN_PAGES, *d.HOME_PAGES)
BROWSE_PATTERNS = (
    *LOGIN_PATTERNS,
    *d.LIST_PAGES,
    *d.PRODUCT_PAGES,
    *d.ORDER_PAGES,
    *d.CART_PAGES,
)
PAGE_TYPES = {
    "login": d.LOGIN_PAGES,
    "eshop": d.HOME_PAGES,
    "itemlist": d.LIST_PAGES,
    "product": d.PRODUCT_PAGES,
    "order": d.ORDER_PAGES,
}


def _views(logs: DataFrame, known: DataFrame | None, *columns: Column | str) -> DataFrame:
    """Page views of known users: (id, *columns)."""
    rows = logs.withColumn("_user", whole_number(logs, "global_user_id"))
    return within(rows, known, "_user").select(F.col("_user").alias("id"), *columns)


def _hour(logs: DataFrame) -> Column:
    return F.hour(timestamp_value(logs, "log_time"))


# --- tags that label plain aggregates of a user's page views ---


def frequency_tag(
    name: str,
    patterns: Sequence[str],
    bands: Sequence[tuple[float, str]],
    rare: str,
    views: str | None = None,
) -> GroupTag:
    """Number of views of pages that match `patterns`; users without one have no tag.

    A row is one view, or as many as its column `views` says.
    """
    hit = any_like(F.col("loc_url"), patterns)
    hits = f"_{name}"
    count = F.count_if(hit) if views is None else F.sum(F.when(hit, F.col(views)))
    return GroupTag(
        name,
        {hits: count},
        band(F.col(hits), bands, rare),
        present=F.col(hits) > 0,
        rows=hit,
        metric=F.col(hits),
    )


def browse_frequency_tag(bands=None, views=None) -> GroupTag:
    return frequency_tag(
        "browseFrequency", BROWSE_PATTERNS, bands or d.BROWSE_BANDS, d.BROWSE_RARE, views
    )


def login_frequency_tag(bands=None, views=None) -> GroupTag:
    return frequency_tag(
        "loginFrequency", LOGIN_PATTERNS, bands or d.LOGIN_BANDS, d.LOGIN_RARE, views
    )


def browse_period_tag() -> GroupTag:
    """Part of the day with most views; hour 0 is in no part, a tie goes to the first part."""
    hour = F.col("_hour")
    counts = {
        f"_hours_{label}": F.count_if(hour.between(first, last))
        for first, last, label in d.HOUR_PERIODS
    }
    values = [(label, F.col(f"_hours_{label}")) for _, _, label in d.HOUR_PERIODS]
    return GroupTag(
        "browsePeriod",
        counts,
        first_max(values),
        metric=F.greatest(*[v for _, v in values]),
    )


def device_tag() -> GroupTag:
    """Most frequent device; a tie goes to the smaller name, unknown agents do not count."""
    device = F.col("_device")
    names = sorted({name for _, name in d.DEVICES})
    values = [(name, F.col(f"_device_{name}")) for name in names]
    top = F.greatest(*[v for _, v in values])
    return GroupTag(
        "deviceType",
        {f"_device_{name}": F.count_if(device == name) for name in names},
        first_max(values),
        present=top > 0,
        rows=device.isNotNull(),
        metric=top,
    )


def device_of_agent(agent: str = "user_agent") -> Column:
    return first_like(F.col(agent), d.DEVICES)


def event_frequency(
    logs: DataFrame,
    name: str,
    patterns: Sequence[str],
    bands: Sequence[tuple[float, str]],
    rare: str,
    known: DataFrame | None = None,
    with_metric: bool = False,
) -> DataFrame:
    """Band of the number of views that match any of `patterns`."""
    tag = frequency_tag(name, patterns, bands, rare)
    return group_tag(_views(logs, known, "loc_url"), "id", tag, with_metric)


def browse_frequency(logs, bands=None, known=None, with_metric=False) -> DataFrame:
    """How often a user views shop pages."""
    rows = _views(logs, known, "loc_url")
    return group_tag(rows, "id", browse_frequency_tag(bands), with_metric)


def login_frequency(logs, bands=None, known=None, with_metric=False) -> DataFrame:
    """How often a user views login and home pages."""
    rows = _views(logs, known, "loc_url")
    return group_tag(rows, "id", login_frequency_tag(bands), with_metric)


def browse_period(logs, known=None, with_metric=False) -> DataFrame:
    """Part of the day in which a user views most pages."""
    rows = _views(logs, known, _hour(logs).alias("_hour"))
    return group_tag(rows, "id", browse_period_tag(), with_metric)


def device_type(logs, known=None, with_metric=False) -> DataFrame:
    """Device a user views most pages with."""
    rows = _views(logs, known, device_of_agent().alias("_device"))
    return group_tag(rows, "id", device_tag(), with_metric)


def log_tags(logs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The four tags above in one pass over the page views."""
    rows = _views(
        logs, known, "loc_url", _hour(logs).alias("_hour"), device_of_agent().alias("_device")
    )
    tags = [browse_frequency_tag(), login_frequency_tag(), browse_period_tag(), device_tag()]
    return group_tags(rows, "id", tags)


def page_tags(logs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Browse frequency, login frequency and least viewed URL in one pass over the URLs.

    Views are counted by user and URL, as the URL tag needs anyway, and all three
    tags are read off the counts.
    """
    pages = value_counts(_views(logs, known, "loc_url"), "id", "loc_url")
    url = GroupTag(
        "urlBrowse",
        {"_best": best_value("loc_url", ascending=True)},
        F.col("_best.value"),
    )
    tags = [browse_frequency_tag(views="_n"), login_frequency_tag(views="_n"), url]
    return group_tags(pages, "id", tags)


def activity_tags(logs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Browse period and device in one pass over the times and agents."""
    rows = _views(logs, known, _hour(logs).alias("_hour"), device_of_agent().alias("_device"))
    return group_tags(rows, "id", [browse_period_tag(), device_tag()])


def page_type_counts(logs: DataFrame) -> DataFrame:
    """Views by page type of every user, zeros included; views without a user group as null."""
    return (
        logs.select(whole_number(logs, "global_user_id").alias("id"), "loc_url")
        .groupBy("id")
        .agg(*[F.count_if(any_like(F.col("loc_url"), p)).alias(n) for n, p in PAGE_TYPES.items()])
    )


# --- tags from the time of the views ---


def browse_time(
    logs: DataFrame,
    bands=None,
    known: DataFrame | None = None,
    with_metric: bool = False,
    short: str = d.GAP_SHORT,
) -> DataFrame:
    """Time between the last two views of a user's last day."""
    rows = _views(logs, known, epoch_seconds(logs, "log_time").alias("_second"))
    gaps = last_gap(rows, "id", "_second")
    label = band(F.col("gap"), bands or d.GAP_BANDS, short, strict=True)
    metric = [F.col("gap").alias("metric")] if with_metric else []
    return gaps.select(F.col("id").cast("string").alias("id"), label.alias("browseTime"), *metric)


def last_login(
    users: DataFrame,
    bands=None,
    known: DataFrame | None = None,
    with_metric: bool = False,
    unit_seconds: int = 86400,
) -> DataFrame:
    """How long before the newest login of all users a user logged in last.

    The newest login is a scalar subquery: one value, computed by a distributed
    maximum over all users.
    """
    logins = users.select(
        whole_number(users, "id").alias("id"), whole_number(users, "lastLoginTime", "bigint").alias("_at")
    )
    newest = logins.agg(F.max("_at")).scalar()
    aged = within(logins, known).select("id", F.abs(F.col("_at") - newest).alias("_age"))
    cuts = [(days * unit_seconds, label) for days, label in bands or d.LOGIN_AGE_BANDS]
    metric = [F.col("_age").alias("metric")] if with_metric else []
    return aged.select(
        F.col("id").cast("string").alias("id"),
        band(F.col("_age"), cuts, d.LOGIN_AGE_FRESH, strict=True).alias("lastLogin"),
        *metric,
    )


# --- tags that rank values ---


def url_browse(
    logs: DataFrame,
    ascending: bool = True,
    known: DataFrame | None = None,
    with_metric: bool = False,
) -> DataFrame:
    """Least (or, with `ascending=False`, most) viewed URL of a user."""
    best = top_value(_views(logs, known, "loc_url"), "id", "loc_url", ascending)
    metric = [F.col("n").alias("metric")] if with_metric else []
    return best.select(
        F.col("id").cast("string").alias("id"), F.col("loc_url").alias("urlBrowse"), *metric
    )


# --- tags that look up products ---


def product_names(goods: DataFrame) -> DataFrame:
    """Longest name of every product: (productId, productName), one row per product.

    Order lines repeat the few names of a product; a hash aggregate drops the
    copies before names are compared.
    """
    named = goods.select("productId", "productName").distinct()
    return one_per_key(named, "productId", longest_text("productName")).select(
        F.col("productId").cast("string").alias("productId"), "productName"
    )


def last_browsed_product(
    logs: DataFrame, goods: DataFrame, by: str = "loc_url", known: DataFrame | None = None
) -> DataFrame:
    """Products on the product pages of a user's last such second: (id, productId, productName).

    `by="ref_url"` looks at the referring pages. Views are reduced to one row per
    user and product, and goods to one row per product, before anything is ranked
    or joined. The rank filter runs before the shuffle by user too.
    """
    views = _views(logs, known, F.col(by).alias("_url"), epoch_seconds(logs, "log_time").alias("_at"))
    seen = (
        views.where(any_like(F.col("_url"), d.BROWSED_PRODUCT_PAGES) & F.col("_at").isNotNull())
        .groupBy("id", last_path_segment(F.col("_url")).alias("productId"))
        .agg(F.max("_at").alias("_at"))
    )
    newest = Window.partitionBy("id").orderBy(F.col("_at").desc())
    last = seen.withColumn("_rank", F.rank().over(newest)).where("_rank = 1")
    return last.join(product_names(goods), "productId").select(
        F.col("id").cast("string").alias("id"), "productId", "productName"
    )


def _buyers(orders: DataFrame, known: DataFrame | None) -> DataFrame:
    """(id, orderSn, finishTime) of known users."""
    rows = within(orders.withColumn("_user", member_tail_user(orders)), known, "_user")
    return rows.select(
        F.col("_user").alias("id"),
        "orderSn",
        whole_number(orders, "finishTime", "bigint").alias("finishTime"),
    )


def _ordered_lines(
    orders: DataFrame, goods: DataFrame, known: DataFrame | None, latest_only: bool = False
) -> DataFrame:
    buyers = _buyers(orders, known)
    if latest_only:
        buyers = latest_rows(buyers, "id", "finishTime")
    lines = goods.select(F.col("cOrderSn").alias("orderSn"), "productId", "productName")
    # The lines are the streamed and splittable side, whatever one order holds of them.
    return lines.join(buyers.select("id", "orderSn"), "orderSn")


def purchased_products(
    orders: DataFrame,
    goods: DataFrame,
    known: DataFrame | None = None,
    latest_only: bool = False,
) -> DataFrame:
    """Products a user ordered, each with its longest name: (id, productId, purchaseName).

    With `latest_only`, only those of the orders at the user's newest finish time.
    """
    return _longest_names(_ordered_lines(orders, goods, known, latest_only))


def products_of_lines(lines: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """`purchased_products` from lines that stand beside their order's memberId already."""
    rows = within(lines.withColumn("_user", member_tail_user(lines)), known, "_user")
    return _longest_names(rows.withColumn("id", F.col("_user")))


def _longest_names(lines: DataFrame) -> DataFrame:
    # A text's order needs a sort; repeated names are hashed away before it.
    lines = lines.select("id", "productId", "productName").distinct()
    return lines.groupBy("id", "productId").agg(longest_text("productName")).select(
        F.col("id").cast("string").alias("id"),
        F.col("productId").cast("string").alias("productId"),
        F.col("productName").alias("purchaseName"),
    )


def purchased_product_list(
    orders: DataFrame,
    goods: DataFrame,
    known: DataFrame | None = None,
    products_per_part: int = 100_000,
) -> DataFrame:
    """Names of a user's products in a comma-joined text: (id, part, productPurchased).

    A user has one name per distinct product. Part p holds the products with ids from
    p * products_per_part on, so that a row holds that many at most, whatever the size of
    the catalogue; products without a whole-number id have no part.
    """
    products = purchased_products(orders, goods, known)
    part = F.floor(F.col("productId").try_cast("bigint") / F.lit(products_per_part)).cast("int")
    names = F.array_sort(F.collect_list("purchaseName"))
    return products.groupBy("id", part.alias("part")).agg(
        F.concat_ws(",", names).alias("productPurchased")
    )


def latest_orders(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Orders at a user's newest finish time: (id, orderSn, finishTime); ties are kept."""
    return latest_rows(_buyers(orders, known), "id", "finishTime").select(
        F.col("id").cast("string").alias("id"),
        F.col("orderSn").cast("string").alias("orderSn"),
        "finishTime",
    )
