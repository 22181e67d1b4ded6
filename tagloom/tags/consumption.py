"""Tags from orders: frequency, amounts, cycle, rates and payment mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    band,
    code_label,
    member_user,
    number_value,
    whole_amount,
    whole_number,
    within,
)
from ..operators import GroupTag, group_tag, group_tags, top_value
from . import dictionaries as d

DAY = 86400


def _rows(orders: DataFrame, known: DataFrame | None, *columns: Column | str) -> DataFrame:
    """Orders of known users: (id, *columns)."""
    rows = orders.withColumn("_user", member_user(orders))
    return within(rows, known, "_user").select(F.col("_user").alias("id"), *columns)


def _amount(orders: DataFrame) -> Column:
    return number_value(orders, "orderAmount").alias("_amount")


def _whole(orders: DataFrame) -> Column:
    return whole_amount(orders, "orderAmount").alias("_whole")


def _finished_at(orders: DataFrame) -> Column:
    return whole_number(orders, "finishTime", "bigint").alias("_at")


def _finished() -> Column:
    return F.col("orderStatus") == d.FINISHED


def _if_finished(column: str) -> Column:
    return F.when(_finished(), F.col(column))


# --- tags that label plain aggregates of a user's orders ---


def order_count_tag(bands=None) -> GroupTag:
    n = F.col("_orders")
    return GroupTag(
        "purchaseFrequency",
        {"_orders": F.count(F.lit(1))},
        band(n, bands or d.ORDER_COUNT_BANDS, d.ORDER_COUNT_LOW),
        metric=n,
    )


def _finished_tag(name: str, measures: dict, value: Column, label: Column) -> GroupTag:
    """A tag over finished orders; users without one have no tag."""
    return GroupTag(
        name,
        {"_finished": F.count_if(_finished()), **measures},
        label,
        present=F.col("_finished") > 0,
        rows=_finished(),
        metric=value,
    )


def power_tag(bands=None) -> GroupTag:
    value = F.col("_amount_sum")
    return _finished_tag(
        "consumptionPower",
        {"_amount_sum": F.sum(_if_finished("_amount"))},
        value,
        band(value, bands or d.POWER_BANDS, d.POWER_LOWEST),
    )


def order_value_tag(bands=None) -> GroupTag:
    value = F.col("_amount_avg")
    return _finished_tag(
        "monovalent",
        {"_amount_avg": F.avg(_if_finished("_amount"))},
        value,
        band(value, bands or d.ORDER_VALUE_BANDS, d.ORDER_VALUE_LOWEST),
    )


def max_amount_tag(bands=None) -> GroupTag:
    value = F.col("_whole_max")
    return _finished_tag(
        "maxAmount",
        {"_whole_max": F.max(_if_finished("_whole"))},
        value,
        band(value, bands or d.MAX_AMOUNT_BANDS, d.MAX_AMOUNT_NONE),
    )


def cycle_tag(bands=None) -> GroupTag:
    """Time from the first to the last finished order, divided by their number."""
    value = (F.col("_last_at") - F.col("_first_at")) / F.col("_finished")
    cuts = [(days * DAY, label) for days, label in bands or d.CYCLE_BANDS]
    return _finished_tag(
        "consumptionCycle",
        {
            "_last_at": F.max(_if_finished("_at")),
            "_first_at": F.min(_if_finished("_at")),
        },
        value,
        band(value, cuts, d.CYCLE_SHORTEST),
    )


def rate_tag(name: str, status: str, bands) -> GroupTag:
    """Share of orders with `status` among those that were not cancelled."""
    kept = F.col("orderStatus") != d.CANCELLED
    value = F.col(f"_{name}") / F.col("_kept")
    return GroupTag(
        name,
        {
            "_kept": F.count_if(kept),
            f"_{name}": F.count_if(F.col("orderStatus") == status),
        },
        band(value, bands, d.RATE_LOW),
        present=F.col("_kept") > 0,
        rows=kept,
        metric=value,
    )


def return_tag(bands=None) -> GroupTag:
    return rate_tag("returnRate", d.RETURNED, bands or d.RETURN_BANDS)


def exchange_tag(bands=None) -> GroupTag:
    return rate_tag("exchangeRate", d.EXCHANGED, bands or d.EXCHANGE_BANDS)


def consult_tag(bands=None) -> GroupTag:
    return rate_tag("consultationFrequency", d.CONSULTED, bands or d.CONSULT_BANDS)


def order_frequency(orders, bands=None, known=None, with_metric=False) -> DataFrame:
    """How many orders a user placed, of any status."""
    return group_tag(_rows(orders, known), "id", order_count_tag(bands), with_metric)


def order_amount_band(orders, measure, bands=None, known=None, with_metric=False) -> DataFrame:
    """Band of the sum, mean ("avg") or greatest ("max") amount of finished orders."""
    tag, amount = {
        "sum": (power_tag, _amount),
        "avg": (order_value_tag, _amount),
        "max": (max_amount_tag, _whole),
    }[measure]
    rows = _rows(orders, known, "orderStatus", amount(orders))
    return group_tag(rows, "id", tag(bands), with_metric)


def consumption_power(orders, bands=None, known=None, with_metric=False) -> DataFrame:
    """Total amount of a user's finished orders."""
    return order_amount_band(orders, "sum", bands, known, with_metric)


def purchase_cycle(orders, bands=None, known=None, with_metric=False) -> DataFrame:
    """Mean time between a user's finished orders."""
    rows = _rows(orders, known, "orderStatus", _finished_at(orders))
    return group_tag(rows, "id", cycle_tag(bands), with_metric)


def status_rate(
    orders, status, bands=None, known=None, with_metric=False, name=None
) -> DataFrame:
    """Share of a user's orders that have `status`."""
    usual = {
        d.RETURNED: ("returnRate", d.RETURN_BANDS),
        d.EXCHANGED: ("exchangeRate", d.EXCHANGE_BANDS),
        d.CONSULTED: ("consultationFrequency", d.CONSULT_BANDS),
    }.get(status, ("rate", d.RETURN_BANDS))
    tag = rate_tag(name or usual[0], status, bands or usual[1])
    return group_tag(_rows(orders, known, "orderStatus"), "id", tag, with_metric)


def order_tags(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The eight tags above in one pass over the orders."""
    rows = _rows(
        orders, known, "orderStatus", _amount(orders), _whole(orders), _finished_at(orders)
    )
    tags = [
        order_count_tag(),
        power_tag(),
        order_value_tag(),
        max_amount_tag(),
        cycle_tag(),
        return_tag(),
        exchange_tag(),
        consult_tag(),
    ]
    return group_tags(rows, "id", tags)


def order_measures(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(id, orders, amount, mean_amount, whole_max, cycle): the measures behind the tags, in one pass."""
    rows = _rows(orders, known, "orderStatus", _amount(orders), _whole(orders), _finished_at(orders))
    at, done = _if_finished("_at"), F.count_if(_finished())
    return rows.groupBy("id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(_if_finished("_amount")).alias("amount"),
        F.avg(_if_finished("_amount")).alias("mean_amount"),
        F.max(_if_finished("_whole")).alias("whole_max"),
        ((F.max(at) - F.min(at)) / F.nullif(done, F.lit(0))).alias("cycle"),
    )


def payment_mode(
    orders: DataFrame,
    known: DataFrame | None = None,
    by_member: bool = False,
    with_metric: bool = False,
) -> DataFrame:
    """Payment mode a user chose most often.

    With `by_member` the mode is chosen per member number, and a user gets one
    row for each of the members that share the id.
    """
    rows = orders.withColumn("id", member_user(orders)).select("memberId", "id", "paymentCode")
    if by_member:
        best = top_value(rows, "memberId", "paymentCode")
        best = within(best.withColumn("id", member_user(best)), known)
    else:
        best = top_value(within(rows, known), "id", "paymentCode")
    columns = [F.col("memberId").cast("string").alias("memberId")] if by_member else []
    columns += [
        F.col("id").cast("string").alias("id"),
        code_label(F.col("paymentCode"), d.PAYMENT_MODES, d.PAYMENT_OTHER).alias("paymentMode"),
    ]
    if with_metric:
        columns.append(F.col("n").alias("metric"))
    return best.select(*columns)
