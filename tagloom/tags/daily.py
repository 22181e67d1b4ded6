"""The tags over plain aggregates, computed from states that are stored by day.

`store_orders` and `store_views` take the rows of some days and replace what is stored for these days; the
other functions read the stored states and give the same tags as the full scans of `consumption`,
`behaviour` and `models.rfm`.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import any_like, band, member_user, number_value, timestamp_value, whole_amount, whole_number
from ..operators import increments as inc
from . import behaviour, consumption
from . import dictionaries as d


def _finished(value: Column) -> Column:
    return F.when(F.col("orderStatus") == d.FINISHED, value)


def _order_measures() -> dict[str, inc.Measure]:
    status = F.col("orderStatus")
    amount, whole, at = F.col("_amount"), F.col("_whole"), F.col("_at")
    return {
        "_orders": inc.count_of(),
        "_finished": inc.count_of(status == d.FINISHED),
        "_amount_sum": inc.sum_of(_finished(amount)),
        "_amount_n": inc.count_of(_finished(amount).isNotNull()),
        "_whole_max": inc.greatest_of(_finished(whole)),
        "_last_at": inc.greatest_of(_finished(at)),
        "_first_at": inc.least_of(_finished(at)),
        "_kept": inc.count_of(status != d.CANCELLED),
        "_returnRate": inc.count_of(status == d.RETURNED),
        "_exchangeRate": inc.count_of(status == d.EXCHANGED),
        "_consultationFrequency": inc.count_of(status == d.CONSULTED),
    }


def _member_measures() -> dict[str, inc.Measure]:
    return {
        "_orders": inc.count_of(F.col("orderSn").isNotNull()),
        "_amount_sum": inc.sum_of(F.col("_amount")),
        "_last_at": inc.greatest_of(F.col("_at")),
    }


def _view_measures() -> dict[str, inc.Measure]:
    url, hour, device = F.col("loc_url"), F.col("_hour"), F.col("_device")
    return {
        "_browseFrequency": inc.count_of(any_like(url, behaviour.BROWSE_PATTERNS)),
        "_loginFrequency": inc.count_of(any_like(url, behaviour.LOGIN_PATTERNS)),
        **{f"_page_{n}": inc.count_of(any_like(url, p)) for n, p in behaviour.PAGE_TYPES.items()},
        **{f"_hours_{label}": inc.count_of(hour.between(a, b)) for a, b, label in d.HOUR_PERIODS},
        **{f"_device_{name}": inc.count_of(device == name) for name in sorted({n for _, n in d.DEVICES})},
    }


def _stored(spark: SparkSession, path: str, until: datetime.date | None) -> DataFrame:
    state = spark.read.parquet(path)
    return state if until is None else state.where(F.col(inc.DAY) <= F.lit(until))


def _order_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        member_user(orders).cast("bigint").alias("id"),
        F.col("memberId").cast("string").alias("memberId"),
        "orderSn",
        F.col("orderStatus").cast("string").alias("orderStatus"),
        number_value(orders, "orderAmount").alias("_amount"),
        whole_amount(orders, "orderAmount").alias("_whole"),
        whole_number(orders, "finishTime", "bigint").alias("_at"),
    )


def _period(at: Column, unit: str) -> Column:
    day = F.to_date(F.timestamp_seconds(at))
    return day if unit == "day" else F.to_date(F.trunc(day, unit))


def store_orders(orders: DataFrame, path: str, unit: str = "day") -> None:
    """Store the states of all days (or of other units of `trunc`) that the orders' finish times lie in.

    `orders` must hold all orders of these days: what is stored for them is replaced.
    """
    rows = _order_rows(orders)
    day = _period(F.col("_at"), unit)
    inc.store_days(inc.day_state(rows, "id", day, _order_measures()), f"{path}/users")
    inc.store_days(inc.day_state(rows, "memberId", day, _member_measures()), f"{path}/members")


def stored_order_tags(spark: SparkSession, path: str, until: datetime.date | None = None) -> DataFrame:
    """The tags of `consumption.order_tags` from stored days, those up to `until` where it is given."""
    merged = inc.merged_state(_stored(spark, f"{path}/users", until), "id", _order_measures())
    merged = merged.withColumn("_amount_avg", F.col("_amount_sum") / F.nullif(F.col("_amount_n"), F.lit(0)))
    tags = [
        consumption.order_count_tag(),
        consumption.power_tag(),
        consumption.order_value_tag(),
        consumption.max_amount_tag(),
        consumption.cycle_tag(),
        consumption.return_tag(),
        consumption.exchange_tag(),
        consumption.consult_tag(),
    ]
    return inc.labelled(merged, "id", tags)


def stored_rfm(
    spark: SparkSession, path: str, as_of: datetime.date | None = None, lag_days: int = 660
) -> DataFrame:
    """(memberId, rencency, frequency, moneyTotal) of `models.rfm.rfm` from stored days."""
    merged = inc.merged_state(_stored(spark, f"{path}/members", None), "memberId", _member_measures())
    today = F.current_date() if as_of is None else F.lit(as_of)
    last = F.to_date(F.timestamp_seconds("_last_at"))
    return merged.select(
        "memberId",
        F.datediff(F.date_sub(today, lag_days), last).alias("rencency"),
        F.col("_orders").alias("frequency"),
        F.col("_amount_sum").alias("moneyTotal"),
    )


def store_views(logs: DataFrame, path: str) -> None:
    """Store the states of all days that the page views lie in; `logs` must hold all views of these days."""
    rows = logs.select(
        whole_number(logs, "global_user_id").cast("bigint").alias("id"),
        "loc_url",
        behaviour.device_of_agent().alias("_device"),
        timestamp_value(logs, "log_time").alias("_time"),
    )
    rows = rows.select("*", F.hour("_time").alias("_hour"), F.unix_timestamp("_time").alias("_second"))
    day = F.to_date("_time")
    inc.store_days(inc.day_state(rows, "id", day, _view_measures()), f"{path}/views")
    inc.store_days(inc.newest_two(rows, "id", day, "_second"), f"{path}/moments")


def _views(spark: SparkSession, path: str, until: datetime.date | None) -> DataFrame:
    return inc.merged_state(_stored(spark, f"{path}/views", until), "id", _view_measures())


def stored_log_tags(spark: SparkSession, path: str, until: datetime.date | None = None) -> DataFrame:
    """The tags of `behaviour.log_tags` from stored days."""
    tags = [
        behaviour.browse_frequency_tag(),
        behaviour.login_frequency_tag(),
        behaviour.browse_period_tag(),
        behaviour.device_tag(),
    ]
    return inc.labelled(_views(spark, path, until), "id", tags)


def stored_page_type_counts(spark: SparkSession, path: str, until: datetime.date | None = None) -> DataFrame:
    """The counts of `behaviour.page_type_counts` from stored days; views without a user are not stored."""
    counts = [F.col(f"_page_{n}").alias(n) for n in behaviour.PAGE_TYPES]
    return _views(spark, path, until).select("id", *counts)


def stored_browse_time(spark: SparkSession, path: str, until: datetime.date | None = None) -> DataFrame:
    """The tag of `behaviour.browse_time` from the two newest seconds of each stored day."""
    gaps = inc.gap_from_state(_stored(spark, f"{path}/moments", until), "id")
    label = band(F.col("gap"), d.GAP_BANDS, d.GAP_SHORT, strict=True)
    return gaps.select(F.col("id").cast("string").alias("id"), label.alias("browseTime"))
