import pytest
from tests.helpers import orders, pairs, rows

from tagloom.operators import metric_mean
from tagloom.tags import consumption as c
from tagloom.tags import dictionaries as d

DAY = 86400


def bought(spark, amounts, status="202"):
    """One order per user, of the given amount."""
    return orders(
        spark,
        *[
            {"memberId": str(i), "orderAmount": a, "orderStatus": status}
            for i, a in enumerate(amounts)
        ],
    )


def labels(df, tag, n):
    found = pairs(df, "id", tag)
    return [found[str(i)] for i in range(n)]


def test_order_frequency_bands_count_every_status(spark):
    counts = {199: "低", 200: "中", 249: "中", 250: "高"}
    table = orders(
        spark,
        *[
            {"memberId": str(n), "orderStatus": ["202", "203", None][i % 3]}
            for n in counts
            for i in range(n)
        ],
    )
    found = pairs(c.order_frequency(table), "id", "purchaseFrequency")
    assert found == {str(n): label for n, label in counts.items()}


def edges(cutoffs, lowest, step=0.01):
    """(amount, label) just under and at every cut-off."""
    names = [label for _, label in cutoffs] + [lowest]
    listed = []
    for i, (cut, label) in enumerate(cutoffs):
        listed += [(f"{cut - step:.2f}", names[i + 1]), (f"{cut:.2f}", label)]
    return listed


@pytest.mark.parametrize(
    "measure, tag, cutoffs, lowest",
    [
        ("sum", "consumptionPower", d.POWER_BANDS, d.POWER_LOWEST),
        ("avg", "monovalent", d.ORDER_VALUE_BANDS, d.ORDER_VALUE_LOWEST),
        ("max", "maxAmount", d.MAX_AMOUNT_BANDS, d.MAX_AMOUNT_NONE),
    ],
)
def test_amount_bands(spark, measure, tag, cutoffs, lowest):
    cases = edges(cutoffs, lowest) + [("-1", lowest), ("bad", lowest), (None, lowest)]
    found = c.order_amount_band(bought(spark, [a for a, _ in cases]), measure)
    assert labels(found, tag, len(cases)) == [label for _, label in cases]


def test_literal_amount_labels(spark):
    cases = ["500000", "200000", "150000", "100000", "50000", "10000", "9999"]
    found = c.consumption_power(bought(spark, cases))
    assert labels(found, "consumptionPower", 7) == ["超高", "高", "中上", "中", "中下", "低", "很低"]


def test_amounts_add_up_over_members_with_one_id(spark):
    table = orders(
        spark,
        {"memberId": "7", "orderAmount": "6000", "orderStatus": "202"},
        {"memberId": "1007", "orderAmount": "4000.5", "orderStatus": "202"},
        {"memberId": "2007", "orderAmount": "99999", "orderStatus": "203"},
        {"memberId": None, "orderAmount": "1", "orderStatus": "202"},
        {"memberId": "99999999999", "orderAmount": "1", "orderStatus": "202"},
        {"memberId": "8", "orderAmount": "1", "orderStatus": None},
    )
    assert rows(c.order_amount_band(table, "sum", with_metric=True)) == {("7", "低", 10000.5)}
    assert rows(c.order_amount_band(table, "avg", with_metric=True)) == {("7", "5000-9999", 5000.25)}
    assert rows(c.order_amount_band(table, "max", with_metric=True)) == {("7", "5000-9999", 6000)}


def test_purchase_cycle(spark):
    cuts = [2, 3, 5, 7, 14, 30, 60, 90, 120, 150, 180]
    names = ["2日", "3日", "5日", "7日", "2周", "1月", "2月", "3月", "4月", "5月", "6月"]
    table = [{"memberId": "0", "orderStatus": "202", "finishTime": "5"}]
    expected = {"0": "1日"}
    for i, (days, name) in enumerate(zip(cuts, names), start=1):
        # Two orders, so the span is twice the interval.
        span = 2 * days * DAY
        for user, last in ((str(2 * i), span), (str(2 * i + 1), span - 1)):
            table += [
                {"memberId": user, "orderStatus": "202", "finishTime": "999999999"},
                {"memberId": user, "orderStatus": "202", "finishTime": str(999999999 + last)},
            ]
        expected[str(2 * i)] = name
        expected[str(2 * i + 1)] = (["1日"] + names)[i - 1]
    table.append({"memberId": "900", "orderStatus": "203", "finishTime": "1"})
    assert pairs(c.purchase_cycle(orders(spark, *table)), "id", "consumptionCycle") == expected


@pytest.mark.parametrize(
    "status, tag, high, mid",
    [
        ("0", "returnRate", 0.02, 0.0002),
        ("1", "exchangeRate", 0.01, 0.0001),
        ("204", "consultationFrequency", 0.02, 0.002),
    ],
)
def test_status_rates(spark, status, tag, high, mid):
    def user(name, hits, total):
        return [
            {"memberId": name, "orderStatus": status if i < hits else "202"} for i in range(total)
        ]

    many = round(1 / mid)
    table = [
        *user("1", 1, round(1 / high)),  # exactly the high cut-off
        *user("2", 1, round(1 / high) + 1),
        *user("3", 0, 5),
        *user("4", 1, many),  # exactly the middle cut-off
        *user("5", 1, many + 1),
        {"memberId": "6", "orderStatus": "203"},
        {"memberId": "7", "orderStatus": None},
        # Cancelled orders and missing states do not dilute the rate.
        {"memberId": "8", "orderStatus": status},
        {"memberId": "8", "orderStatus": "203"},
        {"memberId": "8", "orderStatus": None},
    ]
    found = c.status_rate(orders(spark, *table), status, with_metric=True)
    assert pairs(found, "id", tag) == {
        "1": "高", "2": "中", "3": "低", "4": "中", "5": "低", "8": "高",
    }
    assert pairs(found, "id", "metric")["8"] == 1.0


def test_shared_pass_equals_the_single_tags(spark):
    table = orders(
        spark,
        *[
            {
                "memberId": str(i % 7 * 1000 + i % 5),
                "orderStatus": ["202", "203", "0", "1", "204", None][i * 5 % 6],
                "orderAmount": ["12000.5", "bad", "399", None][i % 4],
                "finishTime": str(10**9 + i * 50000),
            }
            for i in range(300)
        ],
        {"memberId": "6", "orderStatus": "203"},
    )
    singles = {
        "purchaseFrequency": c.order_frequency(table),
        "consumptionPower": c.order_amount_band(table, "sum"),
        "monovalent": c.order_amount_band(table, "avg"),
        "maxAmount": c.order_amount_band(table, "max"),
        "consumptionCycle": c.purchase_cycle(table),
        "returnRate": c.status_rate(table, "0"),
        "exchangeRate": c.status_rate(table, "1"),
        "consultationFrequency": c.status_rate(table, "204"),
    }
    wide = {r.id: r for r in c.order_tags(table).collect()}
    for tag, single in singles.items():
        assert {i: r[tag] for i, r in wide.items() if r[tag] is not None} == pairs(single, "id", tag)


def test_payment_mode(spark):
    table = orders(
        spark,
        *[
            {"memberId": m, "paymentCode": p}
            for m, p in [
                ("1", "wxpay"), ("1", "wxpay"), ("1", "alipay"),
                ("1001", "alipay"), ("1001", "alipay"),
                ("2", "ccb"), ("3", "chinaecpay"), ("4", "chinapay"), ("5", "balance"),
                ("6", "cod"), ("7", None), ("8", None), ("8", None), ("8", "alipay"),
                ("9", "wxpay"), ("9", "alipay"),
            ]
        ],
    )
    expected = {
        "2": "银行卡", "3": "银行卡", "4": "银行卡", "5": "余额", "6": "其他方式", "7": "其他方式",
        "8": "支付宝", "9": "支付宝",
    }
    assert pairs(c.payment_mode(table), "id", "paymentMode") == {"1": "支付宝", **expected}
    by_member = c.payment_mode(table, by_member=True)
    assert {(r.id, r.paymentMode) for r in by_member.collect()} == {
        ("1", "微信"), ("1", "支付宝"), *expected.items(),
    }


def test_metric_mean(spark):
    table = orders(spark, *[{"memberId": m} for m in ("1", "1", "1", "2")])
    found = metric_mean(c.order_frequency(table, with_metric=True), "metric")
    assert rows(found) == {(2, 4, 2.0)}
