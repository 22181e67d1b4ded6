"""Tags from stored days, learned bands and longest prefixes against full scans and plain Python."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from tests.helpers import logs, orders, rows, users

from tagloom.models import rfm
from tagloom.operators import increments as inc
from tagloom.operators import learned
from tagloom.tags import attribute, behaviour, consumption, daily

DAYS = [datetime.date(2024, 1, 1) + datetime.timedelta(days=i) for i in range(6)]


def _seconds(day, rnd):
    return str(int(datetime.datetime(day.year, day.month, day.day, tzinfo=datetime.timezone.utc).timestamp()) + rnd.randrange(86400))


def _orders(rnd, day, n):
    return [
        {"memberId": str(rnd.choice([1, 2, 3, 1002])), "orderSn": rnd.choice(["s", None]), "orderAmount": rnd.choice(["12.5", "700000", "bad", None]),
         "orderStatus": rnd.choice(["202", "203", "0", "1", "204", None]), "finishTime": None if day is None else _seconds(day, rnd)}
        for _ in range(n)
    ]


def test_orders_of_days_equal_the_full_scan(spark, tmp_path):
    rnd, path = random.Random(1), str(tmp_path)
    by_day = {day: _orders(rnd, day, 15) for day in [*DAYS, None]}
    for part in ([DAYS[0], DAYS[2]], [DAYS[4]], [DAYS[1], None], [DAYS[3], DAYS[5]]):  # two of them come late
        daily.store_orders(orders(spark, *[o for d in part for o in by_day[d]]), path)
    for day in (DAYS[2], DAYS[5]):  # days come again: one with other orders, one as it was
        by_day[day] = by_day[day][:5] if day == DAYS[2] else by_day[day]
        daily.store_orders(orders(spark, *by_day[day]), path)
    everything = orders(spark, *[o for d in by_day.values() for o in d])
    assert rows(daily.stored_order_tags(spark, path)) == rows(consumption.order_tags(everything))
    as_of = datetime.date(2026, 1, 1)
    assert rows(daily.stored_rfm(spark, path, as_of)) == rows(rfm.rfm(everything, as_of))
    early = orders(spark, *[o for d, own in by_day.items() if d is None or d <= DAYS[3] for o in own])
    assert rows(daily.stored_order_tags(spark, path, until=DAYS[3])) == rows(consumption.order_tags(early))


def test_views_of_days_equal_the_full_scan(spark, tmp_path):
    rnd, path = random.Random(2), str(tmp_path)
    urls = ["/login", "http://www.eshop.com/", "/item/1.html", "/product/2.html", "/order/3", "/cart", None, "/x"]
    agents = ["Windows", "Android Linux", "iPad", "Mac", "none", None]
    by_day = {
        day: [
            {"global_user_id": rnd.choice(["1", "2", "3", "bad"]), "loc_url": rnd.choice(urls), "user_agent": rnd.choice(agents),
             "log_time": f"{day} {rnd.randrange(24):02d}:0{rnd.randrange(2)}:0{rnd.randrange(3)}"}
            for _ in range(12)
        ]
        for day in DAYS
    }
    for part in ([DAYS[5]], DAYS[:3], [DAYS[3], DAYS[4]], [DAYS[1]]):
        daily.store_views(logs(spark, *[v for d in part for v in by_day[d]]), path)
    everything = logs(spark, *[v for d in by_day.values() for v in d])
    assert rows(daily.stored_log_tags(spark, path)) == rows(behaviour.log_tags(everything))
    assert rows(daily.stored_browse_time(spark, path)) == rows(behaviour.browse_time(everything))
    assert rows(daily.stored_page_type_counts(spark, path)) == rows(behaviour.page_type_counts(everything).where("id IS NOT NULL"))


def test_a_base_takes_new_days(spark):
    measures = {"n": inc.count_of(), "top": inc.greatest_of(F.col("v")), "low": inc.least_of(F.col("v")), "sum": inc.sum_of(F.col("v"))}
    table = spark.createDataFrame([(k, d, v) for k in "ab" for d in range(4) for v in range(d + 1)], "k string, d int, v int")
    day = F.date_add(F.lit("2024-01-01"), F.col("d"))
    state = inc.day_state(table, "k", day, measures)
    old, new = (state.where(F.col(inc.DAY) < "2024-01-03"), state.where(F.col(inc.DAY) >= "2024-01-03"))
    base = inc.merged_state(old, "k", measures)
    assert rows(inc.rolled(base, new, "k", measures)) == {("a", 10, 3, 0, 10), ("b", 10, 3, 0, 10)}


# --- learned bands ---


@pytest.mark.parametrize("k, n", [(4096, 3000), (200, 20_000)])
def test_learned_edges_lie_within_the_stated_error(spark, k, n):
    rnd = random.Random(n)
    values = [rnd.lognormvariate(3, 2) for _ in range(n)]
    table = spark.createDataFrame([(i, v, i % 7, v if i % 2 else None) for i, v in enumerate(values)], "id int, v double, day int, half double")
    metrics = {"v": F.col("v"), "half": F.col("half"), "none": F.lit(None).cast("double")}
    shares = [(0.9, "a"), (0.5, "b"), (0.1, "c")]
    sketches = learned.metric_sketches(table, metrics, by=["day"], k=k)
    merged = learned.merged_sketches(sketches, list(metrics))
    cuts = learned.learned_cuts(merged, {m: shares for m in metrics})
    assert cuts["none"] == []
    for name, own in (("v", sorted(values)), ("half", sorted(v for i, v in enumerate(values) if i % 2))):
        for (edge, label), (share, wanted) in zip(cuts[name], shares, strict=True):
            rank = sum(v <= edge for v in own) / len(own)
            assert label == wanted
            assert abs(rank - share) <= (learned.rank_error(k) if len(own) > k else 0) + 1 / len(own)


def test_labels_of_learned_bands(spark):
    table = spark.createDataFrame([(i, float(i)) for i in range(1, 101)] + [(200, None)], "id int, v double")
    found = learned.learned_bands(table, "id", {"t": F.col("v")}, {"t": [(0.75, "high"), (0.5, "middle")]}, "low")
    counts = {r.t: r["count"] for r in found.groupBy("t").count().collect()}
    assert counts == {"high": 26, "middle": 25, "low": 49, None: 1}
    # Equal values get one label, and an edge that is not below the one before it is left out.
    same = spark.createDataFrame([(i, 1.0) for i in range(9)], "id int, v double")
    found = learned.learned_bands(same, "id", {"t": F.col("v")}, {"t": [(0.75, "high"), (0.5, "middle")]}, "low")
    assert {r.t for r in found.collect()} == {"high"}


# --- longest prefixes ---


def test_longest_prefix_equals_brute_force(spark):
    rnd = random.Random(6)
    prefixes = {"".join(rnd.choice("12") for _ in range(rnd.randrange(2, 11))) for _ in range(120)}
    table = [(p, f"P{p}", rnd.choice(["", f"C{p}", None])) for p in sorted(prefixes)]
    numbers = ["".join(rnd.choice("12") for _ in range(11)) for _ in range(80)] + ["1", "", "12-12 12", None]
    # The own country's code goes, another's stays and begins no prefix here.
    written = [rnd.choice(["{}", "+86{}", "0086 {}", "+{}"]).format(n) if n else n for n in numbers]
    people = users(spark, *[{"id": str(i), "mobile": m} for i, m in enumerate(written)], {"id": "0", "mobile": written[0]})
    regions = spark.createDataFrame(table, "prefix string, province string, city string")
    found = attribute.longest_prefix_regions(people, regions, {"place": "city", "area": "province"})

    def brute(number):
        digits = "".join(c for c in number or "" if c.isdigit())
        hits = [r for r in table if 3 <= len(r[0]) <= 9 and digits.startswith(r[0])]
        best = max(hits, key=lambda r: len(r[0]), default=None)
        return (best and best[2]) or "未知", (best and best[1]) or "未知"

    want = [(str(i), *brute(n)) for i, n in enumerate(numbers)] + [("0", *brute(numbers[0]))]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
