import datetime
import math

import pytest
from pyspark.sql import functions as F
from tests.helpers import goods, logs, orders, pairs, rows

from tagloom.models import als, ratings, rfm
from tagloom.operators import top_items
from tagloom.tags import dictionaries as d


def clicks(spark, *seen):
    """Page views from (user, product, times)."""
    return logs(
        spark,
        *[
            {"global_user_id": u, "loc_url": f"/product/{p}.html"}
            for u, p, n in seen
            for _ in range(n)
        ],
    )


LINES = [
    {"productId": "1", "brandId": "297", "productType": "烤箱"},
    {"productId": "1", "brandId": "297", "productType": "烤箱"},
    {"productId": "2", "brandId": "297", "productType": "滤芯"},
    {"productId": "3", "brandId": "x", "productType": "其他物"},
    {"productId": "9", "brandId": "305", "productType": "烤箱"},
    {"productId": "bad", "brandId": "305", "productType": "烤箱"},
]


def test_product_ratings(spark):
    table = clicks(spark, ("1", "1", 2), ("1", "abc", 1), (None, "1", 1)).union(
        logs(spark, {"global_user_id": "1", "loc_url": "/item/1.html"}, {"global_user_id": "1"})
    )
    assert rows(ratings.product_ratings(table)) == {(1, 1, 2), (None, 1, 1)}


def test_brand_ratings(spark):
    views = clicks(spark, ("1", "1", 2), ("1", "2", 1), ("2", "3", 4), ("2", "7", 1), (None, "1", 1))
    table = goods(spark, *LINES)
    assert rows(ratings.brand_ratings(table, views)) == {(1, 297, 3)}
    # Two order lines of product 1 count its views twice.
    assert rows(ratings.brand_ratings(table, views, dedupe=False)) == {(1, 297, 5)}
    assert rows(ratings.brand_rating_rows(table, views)) == {
        (1, 297, 2, 2), (None, 297, 1, 2), (1, 297, 1, 1), (2, None, 4, 1), (None, 305, None, 2),
    }


def test_category_ratings(spark):
    views = clicks(spark, ("1", "1", 2), ("1", "2", 1), ("2", "3", 4))
    table = goods(spark, *LINES)
    assert rows(ratings.category_ratings(table, views)) == {(1, 19, 2), (1, 10, 1), (2, 0, 4)}
    assert rows(ratings.category_rating_rows(table, views)) == {
        (1, 19, 2, 2), (1, 10, 1, 1), (2, 0, 4, 1),
    }
    own = ratings.category_ratings(table, views, categories={"其他物": 7})
    assert rows(own) == {(1, 0, 3), (2, 7, 4)}


def test_split_is_whole_and_repeatable(spark):
    table = spark.range(5000).select(
        (F.col("id") % 100).cast("int").alias("userId"),
        (F.col("id") / 100).cast("int").alias("productId"),
        F.lit(1).alias("rating"),
    )
    train, test = ratings.split_ratings(table, "productId")
    assert train.count() + test.count() == 5000
    assert train.join(test, ["userId", "productId"]).count() == 0
    assert 0.77 < train.count() / 5000 < 0.83
    again, _ = ratings.split_ratings(table.repartition(3), "productId")
    assert rows(again) == rows(train)
    other, _ = ratings.split_ratings(table, "productId", seed=1)
    assert rows(other) != rows(train)


@pytest.fixture(scope="module")
def rated(spark):
    """Two groups of users with separate tastes."""
    listed = [(u, p, 5) for u in range(20) for p in range(10) if (u % 2 == p % 2)]
    return spark.createDataFrame(listed, "userId int, productId int, rating bigint")


def test_als(spark, rated, tmp_path):
    model = als.fit_als(rated, "productId", blocks=2)
    path = str(tmp_path / "model")
    als.save_model(model, path)
    als.save_model(model, path)  # a saved model is replaced
    loaded = als.load_model(path)
    recs = als.recommend(loaded, 4)
    assert recs.schema["recommendations"].dataType.elementType.names == ["productId", "rating"]
    for row in recs.collect():
        scores = [r.rating for r in row.recommendations]
        assert len(scores) == 4 and scores == sorted(scores, reverse=True)
        assert all(r.productId % 2 == row.userId % 2 for r in row.recommendations)
    rmse = als.als_rmse(loaded, rated).collect()[0]
    assert rmse.predictions == rated.count() and math.isfinite(rmse.rmse)
    unseen = spark.createDataFrame([(99, 1, 5)], rated.schema)
    assert als.als_rmse(loaded, unseen).collect()[0].predictions == 0
    repeated = als.recommend(als.fit_als(rated, "productId", blocks=2), 4)
    assert rows(als.favor_products(repeated)) == rows(als.favor_products(recs))
    # The item side of a loaded model is broadcast by its size.
    plan = recs._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "CartesianProduct" not in plan


def test_recommendations_and_rmse_follow_from_the_factors(spark, rated, tmp_path):
    model = als.fit_saved(rated, "productId", str(tmp_path / "model"))
    people = {r.id: r.features for r in model.userFactors.collect()}
    things = {r.id: r.features for r in model.itemFactors.collect()}

    def score(user, item):
        return sum(a * b for a, b in zip(people[user], things[item]))

    for row in als.recommend(model, 3).collect():
        best = sorted((score(row.userId, i) for i in things), reverse=True)[:3]
        for entry, expected in zip(row.recommendations, best):
            assert entry.rating == pytest.approx(expected, abs=1e-5)
            assert entry.rating == pytest.approx(score(row.userId, entry.productId), abs=1e-5)
    errors = [(r.rating - score(r.userId, r.productId)) ** 2 for r in rated.collect()]
    rmse = als.als_rmse(model, rated).collect()[0].rmse
    assert rmse == pytest.approx(math.sqrt(sum(errors) / len(errors)), rel=1e-5)


def test_fit_drops_null_ratings(spark, rated):
    holes = spark.createDataFrame([(None, 1, 5), (1, None, 5), (1, 1, None)], rated.schema)
    model = als.fit_als(rated.union(holes), "productId", blocks=2, checkpoint=False)
    assert als.recommend(model, 1).count() == 20


def recs(spark, item, *lists):
    return spark.createDataFrame(
        [(u, [(i, 1.0) for i in items]) for u, items in lists],
        f"userId int, recommendations array<struct<{item}: int, rating: float>>",
    )


def test_lists_and_slots(spark):
    table = recs(spark, "productId", (1, [3, 1, 2]), (2, [7]), (3, []))
    csv = als.recs_to_csv(table, "productId", "favorProducts")
    assert rows(csv) == {(1, "3,1,2"), (2, "7"), (3, "")}
    assert rows(als.explode_slots(table, "productId", 2, "slot")) == {
        ("1", 3, 1), ("2", 7, None), ("3", None, None),
    }
    assert rows(als.csv_slots(csv, "favorProducts", 2, "slot")) == {
        (1, "3", "1"), (2, "7", None), (3, "", None),
    }


def test_favor_brands(spark):
    table = recs(spark, "brandId", (1, [297, 298]), (2, [305, 1]), (3, [299]))
    assert rows(als.favor_brands(table)) == {
        ("1", "海尔", "卡萨帝"), ("2", "MOOKA", "其他"), ("3", "统帅", "其他"),
    }
    first = als.recs_to_csv(recs(spark, "brandId", (1, [1]), (2, [1]), (3, [2])), "brandId", "b")
    assert rows(als.label_histogram(first, "b")) == {("1", 2), ("2", 1)}


def test_favor_types(spark):
    codes = list(range(1, 21)) + [0, 21]
    table = recs(spark, "productType", *[(c, [c] * 10) for c in codes])
    found = {int(r.id): set(r[1:]) for r in als.favor_types(table).collect()}
    names = {code: {name} for name, code in d.CATEGORIES.items()}
    assert found == {**names, 0: {"其他"}, 21: {"其他"}}
    assert found[1] == {"电热水器"} and found[20] == {"嵌入式厨电"}


def test_top_items(spark):
    table = spark.createDataFrame(
        [(1, 5, 2), (1, 4, 2), (1, 3, 9), (2, 1, 1)], "userId int, productId int, rating bigint"
    )
    best = als.recs_to_csv(top_items(table, "userId", "productId", "rating", 2), "productId", "p")
    assert rows(best) == {(1, "3,4"), (2, "1")}


AS_OF = datetime.date(2022, 1, 1)
LAST_DAY = AS_OF - datetime.timedelta(days=660)


def epoch(days_before):
    day = LAST_DAY - datetime.timedelta(days=days_before)
    return str(int(datetime.datetime(day.year, day.month, day.day, 13, tzinfo=datetime.UTC).timestamp()))


def test_recency(spark):
    cases = {0: None, 1: 5, 3: 5, 4: 4, 6: 4, 7: 3, 9: 3, 10: 2, 15: 2, 16: 1, -1: None}
    table = orders(
        spark,
        *[
            {"memberId": f"m{n}", "orderSn": "s", "orderAmount": "1", "finishTime": epoch(n)}
            for n in cases
        ],
    )
    measured = rfm.rfm(table, AS_OF)
    assert pairs(measured, "memberId", "rencency") == {f"m{n}": n for n in cases}
    assert pairs(rfm.rfm_score(measured), "memberId", "rencency") == {
        f"m{n}": s for n, s in cases.items()
    }


def test_last_finish_time_is_compared_as_a_number(spark):
    table = orders(
        spark,
        {"memberId": "m", "orderSn": "a", "orderAmount": "2", "finishTime": "999999999"},
        {"memberId": "m", "orderSn": None, "orderAmount": "bad", "finishTime": epoch(5)},
    )
    assert rows(rfm.rfm(table, AS_OF)) == {("m", 5, 1, 2.0)}


def test_frequency_and_money_scores(spark):
    counts = {0: None, 1: 1, 49: 1, 50: 2, 99: 2, 100: 3, 149: 3, 150: 4, 199: 4, 200: 5}
    money = {
        9999.0: 1, 9999.5: None, 10000.0: 2, 49999.0: 2, 49999.5: None, 50000.0: 3, 99999.0: 3,
        99999.5: None, 100000.0: 4, 199999.0: 4, 199999.5: None, 200000.0: 5, -5.0: 1,
    }
    table = spark.createDataFrame(
        [(f"f{n}", 1, n, 0.0) for n in counts] + [(f"m{m}", 1, 1, m) for m in money],
        "memberId string, rencency int, frequency bigint, moneyTotal double",
    )
    scored = rfm.rfm_score(table)
    frequency = pairs(scored, "memberId", "frequency")
    assert {n: frequency[f"f{n}"] for n in counts} == counts
    total = pairs(scored, "memberId", "moneyTotal")
    assert {m: total[f"m{m}"] for m in money} == money


def test_weighted_points_have_the_centres_of_the_members(spark):
    """One pass over weighted points moves the centres to the means of all members."""
    listed = [(f"a{i}", 1, 1, 1) for i in range(30)] + [(f"b{i}", 1, 2, 1) for i in range(10)]
    listed += [(f"c{i}", 5, 5, 5) for i in range(7)]
    schema = "memberId string, rencency int, frequency int, moneyTotal int"
    model = rfm.fit_segments(spark.createDataFrame(listed, schema), k=2, iterations=5)
    centres = sorted(tuple(round(float(x), 6) for x in c) for c in model.clusterCenters())
    assert centres == [(1.0, 1.25, 1.0), (5.0, 5.0, 5.0)]


def test_segments(spark):
    listed = [(f"{r}{f}{m}-{i}", r, f, m) for r in (1, 5) for f in (1, 5) for m in (1, 5) for i in range(9)]
    schema = "memberId string, rencency int, frequency int, moneyTotal int"
    table = spark.createDataFrame([*listed, ("gap", None, 1, 1)], schema)
    found = rfm.rfm_segments(table)
    assert found.columns == ["memberId", "rencency", "frequency", "moneyTotal", "predict"]
    assert found.count() == len(listed)
    segments = pairs(found, "memberId", "predict")
    assert set(segments.values()) <= set(range(4)) and len(set(segments.values())) == 4
    # Members with equal scores share a segment, however the rows are spread.
    assert all(segments[f"{m[0][:3]}-0"] == segments[m[0]] for m in listed)
    assert pairs(rfm.rfm_segments(table.repartition(7)), "memberId", "predict") == segments
