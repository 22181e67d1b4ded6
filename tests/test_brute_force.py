"""Operators against plain Python over random small tables, and properties of the profile."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tests.conftest import TESTDATA
from tests.helpers import goods, logs, rows

from tagloom.operators import last_gap, latest_rows, longest_text, one_per_key, top_items, top_value
from tagloom.plans.queries import QUERIES
from tagloom.tags import behaviour
from tagloom.tags import dictionaries as d

SF = str(TESTDATA / "sf0.001")


def grouped(listed):
    groups = defaultdict(list)
    for key, *values in listed:
        groups[key].append(values[0] if len(values) == 1 else tuple(values))
    return groups


@pytest.mark.parametrize("seed", [1, 2])
def test_top_value(spark, seed):
    rng = random.Random(seed)
    listed = [(rng.randrange(40), rng.choice(["a", "b", "c", None])) for _ in range(400)]
    table = spark.createDataFrame(listed, "k int, v string")
    for ascending in (False, True):
        expected = set()
        for key, values in grouped(listed).items():
            counts = Counter(v for v in values if v is not None)
            if None in values:
                counts[None] = 0
            sign = 1 if ascending else -1
            value, n = min(counts.items(), key=lambda c: (sign * c[1], c[0] is None, c[0] or ""))
            expected.add((key, value, n))
        assert rows(top_value(table, "k", "v", ascending)) == expected


def test_last_gap(spark):
    rng = random.Random(3)
    start = 1_600_000_000
    listed = [(rng.randrange(60), start + rng.randrange(0, 200_000, 40)) for _ in range(300)]
    expected = set()
    for key, seconds in grouped(listed).items():
        distinct = sorted(set(seconds))
        day = distinct[-1] // 86400
        same = [s for s in distinct if s // 86400 == day]
        if len(same) > 1:
            expected.add((key, same[-1] - same[-2]))
    found = last_gap(spark.createDataFrame(listed, "k int, s bigint"), "k", "s")
    assert expected and rows(found) == expected


def test_latest_rows(spark):
    rng = random.Random(4)
    listed = [(rng.randrange(20), rng.choice([1, 2, 3, None]), i) for i in range(200)]
    expected = set()
    for key, values in grouped(listed).items():
        newest = max(s for s, _ in values if s is not None)
        expected |= {(key, s, i) for s, i in values if s == newest}
    found = latest_rows(spark.createDataFrame(listed, "k int, s int, i int"), "k", "s")
    assert rows(found.select("k", "s", "i")) == expected


def test_longest_text(spark):
    rng = random.Random(5)
    texts = ["pan", "pot", "cup, red", "jug, big", "", None, "a,b,c"]
    listed = [(rng.randrange(30), rng.choice(texts)) for _ in range(120)]
    expected = set()
    for key, values in grouped(listed).items():
        known = [v for v in values if v is not None]
        longest = min(known, key=lambda v: (-len(v), v)) if known else ""
        expected.add((key, longest.split(",")[0]))
    table = spark.createDataFrame(listed, "k int, t string")
    assert rows(table.groupBy("k").agg(longest_text("t"))) == expected
    assert rows(one_per_key(table, "k", longest_text("t"))) == expected


def test_top_items(spark):
    rng = random.Random(6)
    listed = list({(rng.randrange(15), rng.randrange(40)): rng.randrange(1, 5) for _ in range(300)}.items())
    listed = [(u, i, r) for (u, i), r in listed]
    expected = {
        u: [i for i, _ in sorted(values, key=lambda v: (-v[1], v[0]))[:3]]
        for u, values in grouped(listed).items()
    }
    table = spark.createDataFrame(listed, "u int, i int, r bigint")
    found = top_items(table, "u", "i", "r", 3)
    assert {r.u: [e.i for e in r.recommendations] for r in found.collect()} == expected


def test_last_browsed_product(spark):
    rng = random.Random(7)
    start = datetime(2020, 1, 1)
    listed = [
        (
            rng.randrange(25),
            start + timedelta(seconds=rng.randrange(30)),
            rng.choice(["/item/", "/product/", "/itemlist/", "/order/"]) + f"{rng.randrange(8)}.html",
        )
        for _ in range(300)
    ]
    names = [(str(rng.randrange(6)), rng.choice(["pan", "pot", "long pan, red"])) for _ in range(20)]
    longest = {
        p: min(ns, key=lambda n: (-len(n), n)).split(",")[0] for p, ns in grouped(names).items()
    }
    expected = set()
    for user, seen in grouped(listed).items():
        shop = [(at, url) for at, url in seen if "/order/" not in url]
        if shop:
            newest = max(at for at, _ in shop)
            products = {url.split("/")[-1].split(".html")[0] for at, url in shop if at == newest}
            expected |= {(str(user), p, longest[p]) for p in products if p in longest}
    found = behaviour.last_browsed_product(
        logs(spark, *[
            {"global_user_id": str(u), "log_time": str(at), "loc_url": url} for u, at, url in listed
        ]),
        goods(spark, *[{"productId": p, "productName": n} for p, n in names]),
    )
    assert expected and rows(found) == expected


LABELS = {
    "gender": {*d.GENDER.values(), d.UNKNOWN},
    "job": {*d.JOB.values(), d.UNKNOWN},
    "marriage": {*d.MARRIAGE.values(), d.UNKNOWN},
    "nationality": {*d.NATIONALITY.values(), d.OTHER},
    "politicalFace": {*d.POLITICAL_FACE.values(), d.OTHER},
    "age": {*dict(d.BIRTH_DECADES).values(), d.OTHER},
    "constellation": {*dict(d.STAR_SIGNS).values()},
    "browseFrequency": {"经常", "较常", "偶尔", "很少"},
    "loginFrequency": {"经常", "一般", "较少", "极少"},
    "browsePeriod": {"1-7", "8-12", "13-17", "18-21", "22-24"},
    "browseTime": {"5分钟以上", "1-5分钟", "1分钟内"},
    "deviceType": {"Window", "Android", "Linux", "IOS", "Mac"},
    "lastLogin": {"30天内", "14天内", "7天内", "1天内"},
    "paymentMode": {"支付宝", "微信", "余额", "银行卡", "其他方式"},
    "returnRate": {"高", "中", "低"},
    "exchangeRate": {"高", "中", "低"},
    "consultationFrequency": {"高", "中", "低"},
    "purchaseFrequency": {"高", "中", "低"},
}


def test_profile_has_one_row_per_id_and_known_labels(spark):
    profile = QUERIES["profile"](spark, SF).cache()
    assert profile.count() == profile.select("id").distinct().count()
    for tag, labels in LABELS.items():
        found = {r[0] for r in profile.select(tag).distinct().collect()} - {None}
        assert found and found <= labels, tag
    profile.unpersist()


def test_page_counts_stay_below_the_views(spark):
    views = spark.read.parquet(f"{SF}/events.parquet").count()
    counts = QUERIES["page_type_counts"](spark, SF)
    kinds = [c for c in counts.columns if c != "id"]
    total = counts.select(sum((F.col(c) for c in kinds), F.lit(0)).alias("n")).agg(F.sum("n")).first()[0]
    assert 0 < total <= 5 * views


@pytest.mark.parametrize(
    "name, tag",
    [
        ("consumption_power", "consumptionPower"),
        ("order_value", "monovalent"),
        ("return_rate", "returnRate"),
        ("consumption_cycle", "consumptionCycle"),
    ],
)
def test_bands_are_monotonous(spark, name, tag):
    """Sorted by the number behind it, a label never comes back."""
    for suffix in ("", "_scaled"):
        table = QUERIES[name + suffix](spark, SF).orderBy("metric").collect()
        seen = [r[tag] for r in table]
        changes = [a for a, b in zip(seen, seen[1:] + [None]) if a != b]
        assert len(changes) == len(set(changes))
