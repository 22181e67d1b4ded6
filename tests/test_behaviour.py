import pytest
from tests.helpers import goods, logs, orders, pairs, rows, users

from tagloom.tags import behaviour as b
from tagloom.tags import dictionaries as d


def views(spark, *pages, user="1"):
    return logs(spark, *[{"global_user_id": user, "loc_url": p} for p in pages])


def many(spark, counts, url):
    listed = [{"global_user_id": str(n), "loc_url": url} for n in counts for _ in range(n)]
    return logs(spark, *listed)


def test_browse_frequency_patterns(spark):
    hits = [
        "/login", "http://eshop.com/", "http://m.eshop.com/?source=mobile", "/itemlist/1", "/l/1",
        "/item/1", "/product/1", "/order/1", "/cart", "/Cart",
    ]
    misses = ["/Login", "http://eshop.com/x", "/CART", "/l", "", None]
    table = views(spark, *hits, *misses)
    assert pairs(b.browse_frequency(table, with_metric=True), "id", "metric") == {"1": len(hits)}
    assert b.browse_frequency(views(spark, *misses)).count() == 0


def test_browse_frequency_bands(spark):
    table = many(spark, [199, 200, 229, 230, 254, 255], "/item/1")
    assert pairs(b.browse_frequency(table), "id", "browseFrequency") == {
        "199": "很少", "200": "偶尔", "229": "偶尔", "230": "较常", "254": "较常", "255": "经常",
    }


def test_login_frequency_bands(spark):
    table = many(spark, [1, 54, 55, 64, 65, 79, 80], "/login")
    assert pairs(b.login_frequency(table), "id", "loginFrequency") == {
        "1": "极少", "54": "极少", "55": "较少", "64": "较少", "65": "一般", "79": "一般", "80": "经常",
    }


def test_known_users_only(spark):
    table = logs(spark, *[{"global_user_id": u, "loc_url": "/login"} for u in ("950", "951", None, "x")])
    known = users(spark, {"id": "950"}, {"id": "950"}, {"id": None})
    assert pairs(b.login_frequency(table, known=known), "id", "loginFrequency") == {"950": "极少"}
    assert set(pairs(b.login_frequency(table), "id", "loginFrequency")) == {"950", "951"}


def test_page_type_counts_keep_everybody(spark):
    table = logs(
        spark,
        {"global_user_id": "1", "loc_url": "/login"},
        {"global_user_id": "1", "loc_url": "http://m.eshop.com/?source=mobile"},
        {"global_user_id": "1", "loc_url": "/item/1/order/2"},
        {"global_user_id": "2", "loc_url": None},
        {"global_user_id": "2000", "loc_url": "/l/9"},
    )
    assert rows(b.page_type_counts(table)) == {
        (1, 1, 1, 0, 1, 1), (2, 0, 0, 0, 0, 0), (2000, 0, 0, 1, 0, 0),
    }


def hours(spark, by_user):
    return logs(
        spark,
        *[
            {"global_user_id": u, "log_time": f"2020-01-01 {h:02d}:00:00"}
            for u, hs in by_user.items()
            for h in hs
        ],
    )


@pytest.mark.parametrize(
    "edges, label",
    [((1, 7), "1-7"), ((8, 12), "8-12"), ((13, 17), "13-17"), ((18, 21), "18-21"), ((22, 23), "22-24")],
)
def test_browse_period_edges(spark, edges, label):
    table = hours(spark, {"1": [edges[0]], "2": [edges[1]]})
    assert set(pairs(b.browse_period(table), "id", "browsePeriod").values()) == {label}


def test_browse_period_ties_and_hour_zero(spark):
    table = hours(spark, {"1": [0], "2": [9, 14], "3": [14, 14, 9], "4": [23, 18]})
    assert pairs(b.browse_period(table), "id", "browsePeriod") == {
        "1": "1-7", "2": "8-12", "3": "13-17", "4": "18-21",
    }


def test_browse_time(spark):
    gaps = {"1": 60, "2": 61, "3": 300, "4": 301}
    table = [
        {"global_user_id": u, "log_time": f"2020-01-01 10:{s // 60:02d}:{s % 60:02d}"}
        for u, gap in gaps.items()
        for s in (0, gap)
    ]
    table += [
        # The newest second occurs twice: the gap runs from the second before it.
        {"global_user_id": "5", "log_time": "2020-01-01 10:00:00"},
        {"global_user_id": "5", "log_time": "2020-01-01 10:00:10"},
        {"global_user_id": "5", "log_time": "2020-01-01 10:00:10"},
        # One second on the last day, none at all, and twice the same one.
        {"global_user_id": "6", "log_time": "2019-12-31 23:59:59"},
        {"global_user_id": "6", "log_time": "2020-01-01 00:00:01"},
        {"global_user_id": "7", "log_time": "bad"},
        {"global_user_id": "8", "log_time": "2020-01-01 00:00:01"},
        {"global_user_id": "8", "log_time": "2020-01-01 00:00:01"},
    ]
    found = b.browse_time(logs(spark, *table), with_metric=True)
    assert pairs(found, "id", "metric") == {**gaps, "5": 10}
    assert pairs(found, "id", "browseTime") == {
        "1": "1分钟内", "2": "1-5分钟", "3": "1-5分钟", "4": "5分钟以上", "5": "1分钟内",
    }


def test_device_type(spark):
    agents = {
        "1": ["Android; Linux"],
        "2": ["iPad like Mac OS X"],
        "3": ["curl"],
        "4": ["Windows NT", "Linux x86", "Linux x86"],
        "5": ["iPhone", "iPad", "Windows"],
        "6": ["Windows", "Linux"],
        "7": [None],
        "8": ["Macintosh"],
    }
    table = logs(
        spark, *[{"global_user_id": u, "user_agent": a} for u, listed in agents.items() for a in listed]
    )
    assert pairs(b.device_type(table), "id", "deviceType") == {
        "1": "Android", "2": "IOS", "4": "Linux", "5": "IOS", "6": "Linux", "8": "Mac",
    }


def test_last_login(spark):
    newest, day = 10_000_000, 86400
    ages = [0, day, day + 1, 7 * day, 7 * day + 1, 14 * day, 14 * day + 1]
    table = users(
        spark,
        *[{"id": str(i), "lastLoginTime": str(newest - a)} for i, a in enumerate(ages)],
        {"id": "7"},
    )
    found = pairs(b.last_login(table), "id", "lastLogin")
    assert [found[str(i)] for i in range(8)] == [
        "1天内", "1天内", "7天内", "7天内", "14天内", "14天内", "30天内", "1天内",
    ]
    assert len(found) == 8
    # The newest login counts even when its user is not a known one.
    later = table.union(users(spark, {"id": "952", "lastLoginTime": str(newest + 30 * day)}))
    assert pairs(b.last_login(later), "id", "lastLogin")["0"] == "30天内"


def test_url_browse(spark):
    table = views(spark, "/a", "/a", "/b", "/c", "/c")
    assert pairs(b.url_browse(table), "id", "urlBrowse") == {"1": "/b"}
    assert pairs(b.url_browse(table, ascending=False), "id", "urlBrowse") == {"1": "/a"}
    with_null = table.union(views(spark, None))
    assert pairs(b.url_browse(with_null, with_metric=True), "id", "metric") == {"1": 0}
    assert pairs(b.url_browse(with_null), "id", "urlBrowse") == {"1": None}
    assert pairs(b.url_browse(views(spark, "/z", "/y")), "id", "urlBrowse") == {"1": "/y"}


def test_shared_passes_equal_the_single_tags(spark):
    table = logs(
        spark,
        *[
            {
                "global_user_id": str(i % 5),
                "log_time": f"2020-01-0{1 + i % 3} {i % 24:02d}:00:00",
                "loc_url": ["/login", "/item/1", "/other", None, "/cart"][i * 7 % 5],
                "user_agent": ["Windows", "iPad", "curl"][i % 3],
            }
            for i in range(200)
        ],
        {"global_user_id": "9", "log_time": "bad", "loc_url": "/other", "user_agent": "curl"},
    )
    singles = [b.browse_frequency, b.login_frequency, b.browse_period, b.device_type]
    tags = ["browseFrequency", "loginFrequency", "browsePeriod", "deviceType"]
    wide = {r.id: r for r in b.log_tags(table).collect()}
    pages = {r.id: r for r in b.page_tags(table).collect()}
    activity = {r.id: r for r in b.activity_tags(table).collect()}
    for single, tag in zip(singles, tags):
        expected = pairs(single(table), "id", tag)
        assert {i: r[tag] for i, r in wide.items() if r[tag] is not None} == expected
        part = pages if tag in ("browseFrequency", "loginFrequency") else activity
        assert {i: r[tag] for i, r in part.items() if r[tag] is not None} == expected
    urls = pairs(b.url_browse(table), "id", "urlBrowse")
    assert {i: r.urlBrowse for i, r in pages.items()} == urls


GOODS = [
    {"cOrderSn": "s1", "productId": "1", "productName": "pan"},
    {"cOrderSn": "s2", "productId": "1", "productName": "big pan, red"},
    {"cOrderSn": "s2", "productId": "2", "productName": "pot"},
    {"cOrderSn": "s3", "productId": "2", "productName": "cup"},
    {"cOrderSn": "s3", "productId": "3", "productName": None},
]


def test_last_browsed_product(spark):
    table = logs(
        spark,
        {"global_user_id": "1", "log_time": "2020-01-01 10:00:00", "loc_url": "/item/1.html"},
        {"global_user_id": "1", "log_time": "2020-01-01 11:00:00", "loc_url": "/product/2.html?x",
         "ref_url": "/itemlist/1.html"},
        {"global_user_id": "1", "log_time": "2020-01-01 11:00:00", "loc_url": "/a.html/product/3.html"},
        {"global_user_id": "1", "log_time": "2020-01-01 11:00:00", "loc_url": "/product/2.html?y"},
        # Later, but no product page.
        {"global_user_id": "1", "log_time": "2020-01-01 12:00:00", "loc_url": "/login"},
        # The last product is unknown: no row, and no older product instead.
        {"global_user_id": "2", "log_time": "2020-01-01 10:00:00", "loc_url": "/item/1.html"},
        {"global_user_id": "2", "log_time": "2020-01-01 11:00:00", "loc_url": "/item/9.html"},
        {"global_user_id": "3", "log_time": "bad", "loc_url": "/item/1.html"},
    )
    found = rows(b.last_browsed_product(table, goods(spark, *GOODS)))
    # Equally long names go by order; a product without a name has an empty one.
    assert found == {("1", "2", "cup"), ("1", "3", "")}
    by_referrer = rows(b.last_browsed_product(table, goods(spark, *GOODS), by="ref_url"))
    assert by_referrer == {("1", "1", "big pan")}


def test_purchased_products(spark):
    table = orders(
        spark,
        {"memberId": "1001", "orderSn": "s1"},
        {"memberId": "2001", "orderSn": "s2"},
        {"memberId": "1002", "orderSn": "s3"},
        {"memberId": "1001", "orderSn": "none"},
        {"memberId": "1001", "orderSn": None},
    )
    lines = goods(spark, *GOODS)
    assert rows(b.purchased_products(table, lines)) == {
        ("1", "1", "big pan"), ("1", "2", "pot"), ("2", "2", "cup"), ("2", "3", ""),
    }
    assert rows(b.purchased_product_list(table, lines)) == {
        ("1", 0, "big pan,pot"), ("2", 0, ",cup"),
    }


def test_long_product_lists_are_dealt_out_whole(spark):
    table = orders(spark, {"memberId": "1", "orderSn": "s"})
    lines = goods(
        spark,
        *[{"cOrderSn": "s", "productId": str(i), "productName": f"p{i:03d}"} for i in range(100)],
    )
    parts = b.purchased_product_list(table, lines, products_per_part=10).collect()
    assert len(parts) == 10
    names = sorted(n for r in parts for n in r.productPurchased.split(","))
    assert names == [f"p{i:03d}" for i in range(100)]


def test_purchases_of_the_latest_orders(spark):
    table = orders(
        spark,
        {"memberId": "1", "orderSn": "s1", "finishTime": "9"},
        {"memberId": "1001", "orderSn": "s3", "finishTime": "10"},
        {"memberId": "2", "orderSn": "s2", "finishTime": None},
    )
    found = b.purchased_products(table, goods(spark, *GOODS), latest_only=True)
    assert rows(found) == {("1", "2", "cup"), ("1", "3", "")}


def test_latest_orders_keep_ties(spark):
    table = orders(
        spark,
        {"memberId": "1", "orderSn": "a", "finishTime": "9"},
        {"memberId": "1001", "orderSn": "b", "finishTime": "10"},
        {"memberId": "2001", "orderSn": "c", "finishTime": "10"},
        {"memberId": "2", "orderSn": "d", "finishTime": None},
    )
    assert rows(b.latest_orders(table)) == {("1", "b", 10), ("1", "c", 10)}


def test_event_frequency_takes_any_patterns(spark):
    found = b.event_frequency(
        views(spark, "/order/1", "/order/2"), "n", d.ORDER_PAGES, [(2, "two")], "one"
    )
    assert pairs(found, "id", "n") == {"1": "two"}
