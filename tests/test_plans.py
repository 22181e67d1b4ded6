"""The plans are the ones wanted: pruned scans, few shuffles, nothing on the driver."""

import re

import pytest
from pyspark.sql import functions as F
from tests.conftest import TESTDATA
from tests.helpers import goods, logs, orders, rows, users

from tagloom import sources as s
from tagloom.models import ratings
from tagloom.plans.profile import build_profile, merge_tags
from tagloom.plans.queries import QUERIES
from tagloom.sources import sample
from tagloom.session import configure
from tagloom.tags import attribute, behaviour, consumption

SF = str(TESTDATA / "sf0.001")
EAGER = {"profile_promote", "profile_staged", "page_type_counts_staged", "rfm_segments", "rfm_segments_coverage"}
LAZY = [n for n in QUERIES if not n.startswith("als_") and n not in EAGER]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range)partitioning", plan(df)))


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python_no_single_task_sort(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "rangepartitioning"):
        assert word not in text
    # One task takes only one-row aggregates and the top rows of a preview.
    singles = text.count("Exchange SinglePartition")
    assert singles == 0 or text.count("Subquery") or name.startswith("mean_")


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("als_favor")])
def test_lists_pair_no_users_with_all_items(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    orders(spark, {"memberId": "1", "orderStatus": "202"}).write.parquet(path)
    text = plan(consumption.consumption_power(s.load_orders(spark, path)))
    assert "EqualTo(orderStatus,202)" in text
    assert "ReadSchema: struct<memberId:string,orderAmount:string,orderStatus:string>" in text
    text = plan(behaviour.browse_time(sample.logs(spark, SF)))
    assert "IsNotNull(user_id)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


@pytest.mark.parametrize(
    "name, count",
    [
        ("attr_all", 0),
        ("consumption_power", 1),
        ("order_tags", 1),
        ("log_tags", 1),
        ("page_type_counts", 1),
        ("rfm_score", 1),
        ("payment_mode", 2),
        ("url_browse", 2),
        ("browse_time", 2),
    ],
)
def test_shuffles(spark, no_broadcast, name, count):
    assert exchanges(QUERIES[name](spark, SF)) == count


def test_ranks_are_limited_before_the_shuffle(spark, no_broadcast):
    for name in ("browse_time", "last_browsed_product", "product_list"):
        assert re.search(r"WindowGroupLimit .*Partial", plan(QUERIES[name](spark, SF)))


def test_parts_are_merged_with_one_shuffle(spark):
    parts = [
        spark.createDataFrame([("1", "a"), ("2", None)], "id string, gender string"),
        spark.createDataFrame([("2", "b")], "id string, job string"),
        spark.createDataFrame([("3", "c")], "id string, zzz string"),
    ]
    merged = merge_tags(parts)
    assert exchanges(merged) == 1
    assert merged.columns == ["id", "gender", "job", "zzz"]
    assert rows(merged) == {("1", "a", None, None), ("2", None, "b", None), ("3", None, None, "c")}


def test_profile_of_empty_and_tiny_tables(spark):
    base = (users(spark), orders(spark), goods(spark), logs(spark))
    assert build_profile(*base).count() == 0
    extra = spark.createDataFrame([("9", "海尔")], "id string, favorBrand_0 string")
    found = build_profile(
        users(spark, {"id": "1", "gender": "1", "lastLoginTime": "5"}),
        orders(spark, {"memberId": "1001", "orderSn": "s", "orderStatus": "202", "orderAmount": "5"}),
        goods(spark, {"cOrderSn": "s", "productId": "4", "productName": "pan"}),
        logs(spark, {"global_user_id": "2", "loc_url": "/item/4.html", "log_time": "2020-01-01 08:00:00"}),
        extra=[extra],
    )
    by_id = {r.id: r for r in found.collect()}
    assert set(by_id) == {"1", "2", "9"}
    one, two = by_id["1"], by_id["2"]
    assert (one.gender, one.purchaseName, one.maxAmount, one.lastLogin) == ("男", "pan", "1-4999", "1天内")
    assert (two.productName, two.browsePeriod, two.urlBrowse, two.gender) == (
        "pan", "8-12", "/item/4.html", None,
    )
    assert by_id["9"].favorBrand_0 == "海尔"


# --- a hot key ---


@pytest.fixture()
def small_partitions(spark, no_broadcast):
    """Partition sizes at which a small table already has a skewed partition."""
    configure(spark)
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    yield
    for name in small:
        spark.conf.unset(name)


def is_split(df):
    """The join of `df` read a skewed partition in pieces."""
    df.collect()
    return "skew=true" in plan(df)


def number(seed, size):
    return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(size)).cast("string")


def hot():
    """True for four rows in five."""
    return F.col("id") % 10 < 8


def test_a_hot_product_is_split_in_the_join(spark, small_partitions):
    """A product with most ratings: its join partition is read by several tasks."""
    views = spark.range(300000).select(
        F.hash("id").cast("string").alias("global_user_id"),
        F.when(hot(), F.lit("/product/1.html"))
        .otherwise(F.concat(F.lit("/product/"), number(1, 97), F.lit(".html")))
        .alias("loc_url"),
    )
    table = spark.range(100).select(
        F.col("id").cast("string").alias("productId"),
        F.when(F.col("id") == 1, "298").otherwise("297").alias("brandId"),
    )
    found = ratings.brand_ratings(table.union(table), views)
    assert is_split(found)
    counts = {r.brandId: r["count"] for r in found.groupBy("brandId").count().collect()}
    viewed = views.select("global_user_id", (F.col("loc_url") == "/product/1.html").alias("hot"))
    users = {r.hot: r["count"] for r in viewed.distinct().groupBy("hot").count().collect()}
    assert counts == {298: users[True], 297: users[False]}


def test_a_hot_order_is_split_in_the_join(spark, small_partitions):
    lines = spark.range(300000).select(
        F.when(hot(), F.lit("7")).otherwise(number(1, 5000)).alias("cOrderSn"),
        number(2, 1000000).alias("productId"),
        F.concat(F.lit("name "), number(3, 1000)).alias("productName"),
    )
    table = spark.range(5000).select(
        F.col("id").cast("string").alias("orderSn"),
        F.col("id").cast("string").alias("memberId"),
        F.lit("1").alias("finishTime"),
    )
    found = behaviour.purchased_products(table, lines)
    assert is_split(found)
    expected = lines.join(table, lines.cOrderSn == table.orderSn).select(
        F.col("memberId").cast("int") % 1000, "productId"
    )
    assert found.count() == expected.distinct().count()


def test_a_hot_mobile_prefix_is_split_in_the_join(spark, small_partitions):
    people = spark.range(300000).select(
        F.col("id").cast("string").alias("id"),
        F.when(hot(), F.lit("13800010000")).otherwise(F.concat(F.lit("139"), number(1, 10**8))).alias("mobile"),
    )
    regions = spark.range(5000).select(
        F.concat(F.lit("139"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("prefix"),
        F.lit("p").alias("province"),
        F.lit("c").alias("city"),
    )
    regions = regions.union(spark.createDataFrame([("1380001", "广东", "深圳")], regions.schema))
    found = attribute.mobile_region(people, regions, "city", "nativePlace")
    assert is_split(found)
    assert found.where("nativePlace = '深圳'").count() == 240000
    assert found.count() == 300000


def test_hot_latest_rows_are_split_in_the_join(spark, small_partitions):
    """Most rows share one key and its newest second; all of them are kept."""
    table = spark.range(300000).select(
        F.when(hot(), F.lit("7")).otherwise(number(1, 900)).alias("memberId"),
        F.hash("id").cast("string").alias("orderSn"),
        F.when(hot(), F.lit("99")).otherwise(number(2, 50)).alias("finishTime"),
    )
    found = behaviour.latest_orders(table)
    assert is_split(found)
    assert found.where("id = '7'").count() == 240000


def test_a_hot_last_product_is_split_in_the_join(spark, small_partitions):
    """The same product is the last one of most users; ids are text, as the names' key is."""
    views = spark.range(300000).select(
        F.col("id").cast("string").alias("global_user_id"),
        F.lit("2020-01-01 10:00:00").alias("log_time"),
        F.concat(F.lit("/item/"), F.when(hot(), F.lit("7")).otherwise(number(1, 5000))).alias("loc_url"),
    )
    lines = spark.range(20000).select(
        F.pmod("id", F.lit(5000)).cast("string").alias("productId"),
        F.concat(F.lit("name "), number(2, 50)).alias("productName"),
    )
    found = behaviour.last_browsed_product(views, lines)
    assert is_split(found)
    assert found.count() == 300000


def test_a_hot_user_moves_few_rows(spark):
    """One user holds nearly all views; map-side aggregation keeps the shuffle small."""
    configure(spark)
    views = spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, F.col("id") % 900).otherwise(7).cast("string").alias("global_user_id"),
        F.date_format(F.timestamp_seconds(1577836800 + F.col("id") % 5000), "yyyy-MM-dd HH:mm:ss").alias("log_time"),
        F.lit("/item/1.html").alias("loc_url"),
        F.lit("Windows").alias("user_agent"),
    )
    found = {r.id: r for r in behaviour.log_tags(views).collect()}
    assert found["7"].browseFrequency == "经常" and found["7"].deviceType == "Window"
    gap = {r.id: r.metric for r in behaviour.browse_time(views, with_metric=True).collect()}
    assert gap["7"] == 1
