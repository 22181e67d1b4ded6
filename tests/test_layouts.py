"""Stored layouts: co-located orders, profiles by range, typed and mixed folders, promotion of many tags."""

import collections
import random

import pytest
from pyspark.sql import functions as F
from tests.helpers import goods, orders, rows

from tagloom import sources as s
from tagloom.sources import colocated, profiles
from tagloom.sources.tables import common_type
from tagloom.tags import behaviour, consumption


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- orders and lines by order number ---


@pytest.fixture()
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_db")
    yield "shop_db"
    spark.sql("DROP DATABASE shop_db CASCADE")


def test_colocated_tables_join_without_an_exchange(spark, database, tmp_path):
    rnd = random.Random(4)
    placed = [{"orderSn": f"s{i}", "memberId": str(1000 + i % 7), "orderAmount": "5"} for i in range(40)]
    # One order holds most of the lines; a line has no order, an order has no lines, two have no number.
    lines = [{"id": str(i), "cOrderSn": "s0", "productId": str(i % 3), "productName": "n" * (i % 5)} for i in range(500)]
    lines += [{"id": str(600 + i), "cOrderSn": f"s{rnd.randrange(39)}", "productId": str(i), "productName": "x"} for i in range(90)]
    lines += [{"id": "900", "cOrderSn": "gone", "productId": "1"}, {"id": "901", "productId": "1"}]
    placed += [{"memberId": "5"}]
    made, sold = orders(spark, *placed), goods(spark, *lines)
    colocated.write_colocated(made, sold, database, str(tmp_path), buckets=8, lines_per_part=20)
    assert rows(colocated.read_orders(spark, database)) == rows(made)
    assert sorted(map(repr, colocated.read_goods(spark, database).collect())) == sorted(map(repr, sold.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = colocated.joined_lines(spark, database, ["memberId"], ["productId", "productName"])
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert joined.count() == 590
        # The buckets are even: the large order is dealt over them.
        sizes = [r["n"] for r in spark.table(f"{database}.goods").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 250
        got = rows(behaviour.products_of_lines(joined))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == rows(behaviour.purchased_products(made, sold))


# --- a profile by ranges of ids ---


def test_a_reader_of_some_ids_opens_few_files(spark, tmp_path):
    # Nearly all ids begin alike.
    ids = [f"10000000{i:04d}" for i in range(3000)] + ["0", "5", "9"]
    profile = spark.createDataFrame([(i, str(n % 3)) for n, i in enumerate(ids)], "id string, job string")
    path = str(tmp_path / "ranged")
    s.write_profile_ranges(profile, path, ranges=10)
    sizes = [r.n for r in spark.read.parquet(f"{path}/ranges").collect()]
    assert len(sizes) == 10 and sum(sizes) == 3003 and max(sizes) < 2 * 3003 / 10
    some = s.read_profile_ranges(spark, path, ids=["100000000005", "100000000006", "nobody"])
    assert sorted(r.id for r in some.collect()) == ["100000000005", "100000000006"]
    assert len(set(r[0] for r in some.select(F.input_file_name()).collect())) == 1
    scan = plan(some)
    assert "PartitionFilters" in scan and "id_range" in scan.split("PartitionFilters")[1]
    between = s.read_profile_ranges(spark, path, low="100000000100", high="100000000199", tags=["job"])
    assert between.columns == ["id", "job"] and between.count() == 100
    assert s.read_profile_ranges(spark, path).count() == 3003
    assert s.read_profile_ranges(spark, path, ids=[]).count() == 0
    with pytest.raises(Exception):
        s.write_profile_ranges(profile, path, ranges=2)


def test_an_empty_profile_has_no_ranges(spark, tmp_path):
    path = str(tmp_path / "none")
    s.write_profile_ranges(spark.createDataFrame([], "id string, job string"), path, ranges=4)
    assert spark.read.parquet(f"{path}/ranges").count() == 0
    assert s.read_profile_ranges(spark, path, ids=["1"]).collect() == []


# --- stored types ---


def test_typed_folders_keep_their_types_and_their_filters(spark, tmp_path):
    path = str(tmp_path / "orders")
    made = [(1, 1001, 7, 12.5, 202, 1600000000), (2, 2, 8, 3.0, 0, 1600000100), (3, 2, 9, 4.0, 202, None)]
    spark.createDataFrame(made, "id long, memberId int, orderSn long, orderAmount double, orderStatus int, finishTime long").write.parquet(path)
    table = s.load_orders(spark, path)
    assert dict(table.dtypes)["orderStatus"] == "int" and dict(table.dtypes)["paymentCode"] == "string"
    power = consumption.consumption_power(table, with_metric=True)
    assert {(r.id, r.metric) for r in power.collect()} == {("1", 12.5), ("2", 4.0)}
    text = plan(consumption.consumption_power(s.load_orders(spark, path, ["memberId", "orderAmount", "orderStatus"])))
    assert "EqualTo(orderStatus,202)" in text
    assert "ReadSchema: struct<memberId:int,orderAmount:double,orderStatus:int>" in text
    renamed = s.load_orders(spark, path, ["memberId"], {"memberId": "orderSn"})
    assert sorted(r.memberId for r in renamed.collect()) == [7, 8, 9]


def test_folders_whose_types_differ_are_one_table(spark, tmp_path):
    a, b, c = (str(tmp_path / n) for n in "abc")
    spark.createDataFrame([(1, 5, 1.5)], "memberId int, orderSn int, orderAmount float").write.parquet(a)
    spark.createDataFrame([(2, 6, 2.5)], "memberId long, orderSn long, orderAmount double").write.parquet(b)
    spark.createDataFrame([("3", "x7")], "memberId string, orderSn string").write.parquet(c)
    two = s.load_orders(spark, [a, b], ["memberId", "orderSn", "orderAmount"])
    assert dict(two.dtypes) == {"memberId": "bigint", "orderSn": "bigint", "orderAmount": "double"}
    assert rows(two) == {(1, 5, 1.5), (2, 6, 2.5)}
    all_three = s.load_orders(spark, [a, b, c], ["memberId", "orderSn", "orderAmount"])
    assert rows(all_three.select("memberId", "orderSn")) == {("1", "5"), ("2", "6"), ("3", "x7")}
    assert "EqualTo(orderSn,6)" in plan(two.where("orderSn = 6")) or "orderSn" in plan(two.where("orderSn = 6"))


def test_common_types():
    from pyspark.sql import types as T

    assert common_type([T.IntegerType(), T.LongType()]) == T.LongType()
    assert common_type([T.IntegerType(), T.DoubleType()]) == T.DoubleType()
    assert common_type([T.LongType(), T.DoubleType()]) == T.StringType()
    assert common_type([T.DecimalType(10, 2), T.DecimalType(8, 4)]) == T.DecimalType(12, 4)
    assert common_type([T.DateType(), T.TimestampType()]) == T.StringType()
    assert common_type([T.NullType(), T.DateType()]) == T.DateType()
    assert common_type([]) == T.StringType()


# --- many tags in one promotion ---


def _stamp(day):
    return F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp")


def test_many_tags_equal_single_promotions(spark, tmp_path):
    rnd = random.Random(8)
    names = [f"t{i}" for i in range(10)]
    profile = spark.createDataFrame([(str(i), *["old"] * 3) for i in range(20)], "id string, t0 string, t1 string, keep string")
    folder, expected = str(tmp_path / "rows"), collections.defaultdict(dict)
    singles = profile
    for day in range(1, 4):
        for name in names:
            part = {str(rnd.randrange(30)): rnd.choice([None, "a", "b"]) for _ in range(12)}
            table = spark.createDataFrame(list(part.items()), f"id string, {name} string")
            s.stage_tags(table, folder, _stamp(day))
            expected[name].update(part)
    staged = spark.read.parquet(folder)
    for name in names:
        singles = s.upsert_tag(singles, spark.createDataFrame(list(expected[name].items()), f"id string, {name} string"), name)
    many = s.promote_tags(profile, staged, names)
    assert many.columns == singles.columns
    assert rows(many) == rows(singles)
    assert plan(profiles.newest_tags(staged, names)).count("Exchange hashpartitioning") == 1


def test_the_newest_row_wins_and_null_replaces(spark):
    profile = spark.createDataFrame([("1", "old", "same"), ("2", "old", "same")], "id string, a string, b string")
    staged = spark.createDataFrame(
        [("1", "a", "early", 1), ("1", "a", None, 3), ("2", "a", "x", 2), ("2", "a", "y", 2), ("3", "b", "new", 1),
         ("1", "other", "z", 9), (None, "a", "q", 9)],
        "id string, tag string, value string, at int",
    ).withColumn("staged_at", F.timestamp_seconds("at"))
    assert rows(s.promote_tags(profile, staged, ["a", "b", "c"])) == {
        ("1", None, "same", None), ("2", "y", "same", None), ("3", None, "new", None)
    }
    known = spark.createDataFrame([("2",)], "id string")
    assert rows(s.promote_tags(profile, staged, ["a"], known)) == {("1", "old", "same"), ("2", "y", "same")}
    assert rows(s.promote_tags(profile, staged.limit(0), ["a"])) == rows(profile)
