import pytest
from tests.helpers import logs, orders, pairs, rows, users
from pyspark.errors import AnalysisException

from tagloom import sources as s
from tagloom.sources import schemas
from tagloom.tags import attribute, consumption


def test_loaders_read_only_what_is_asked(spark, tmp_path):
    path = str(tmp_path / "users")
    users(spark, {"id": "1", "job": "3", "email": "e"}).write.parquet(path)
    found = s.load_users(spark, path, ["id", "job"])
    assert found.columns == ["id", "job"] and rows(found) == {("1", "3")}
    assert s.load_users(spark, path).columns == schemas.USERS.names
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,job:string>" in plan


def test_loader_renames(spark, tmp_path):
    path = str(tmp_path / "users")
    users(spark, {"id": "1", "job": "3"}).write.parquet(path)
    found = s.load_users(spark, path, ["id", "user_agent"], {"user_agent": "job"})
    assert found.columns == ["id", "user_agent"] and rows(found) == {("1", "3")}


def test_loader_fills_missing_columns_with_null(spark, tmp_path):
    path = str(tmp_path / "logs")
    logs(spark, {"id": "1", "loc_url": "/a"}).select("id", "loc_url").write.parquet(path)
    assert rows(s.load_logs(spark, path, ["id", "ref_url"])) == {("1", None)}


@pytest.fixture()
def profile(spark):
    return spark.createDataFrame(
        [("1", "男", "低"), ("2", "女", "高")], "id string, gender string, returnRate string"
    )


def tag(spark, *values):
    return spark.createDataFrame(list(values), "id int, returnRate string")


def test_upsert(spark, profile):
    new = tag(spark, (2, "中"), (3, "高"))
    found = s.upsert_tag(profile, new, "returnRate")
    assert found.columns == profile.columns
    assert rows(found) == {("1", "男", "低"), ("2", "女", "中"), ("3", None, "高")}
    # A null value of the new tag replaces the old one.
    assert rows(s.upsert_tag(profile, tag(spark, (2, None)), "returnRate")) == {
        ("1", "男", "低"), ("2", "女", None),
    }


def test_upsert_adds_a_column(spark, profile):
    new = spark.createDataFrame([("1", "x")], "id string, job string")
    found = s.upsert_tag(profile, new, "job")
    assert found.columns == ["id", "gender", "returnRate", "job"]
    assert rows(found) == {("1", "男", "低", "x"), ("2", "女", "高", None)}


def test_several_columns_are_upserted_in_one_join(spark, profile):
    new = spark.createDataFrame(
        [(2, "中", "x"), (3, None, "y")], "id int, returnRate string, job string"
    )
    found = s.upsert_tags(profile, new, ["returnRate", "job"])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 1
    assert found.columns == ["id", "gender", "returnRate", "job"]
    assert rows(found) == {("1", "男", "低", None), ("2", "女", "中", "x"), ("3", None, None, "y")}


def test_staging_replaces_the_whole_tag(spark, tmp_path):
    folder = str(tmp_path)
    s.stage_tag(tag(spark, (1, "低"), (2, "低")), "returnRate", folder)
    s.stage_tag(tag(spark, (2, "高")), "returnRate", folder)
    assert (tmp_path / "up_returnRate").exists()
    assert rows(s.read_staged_tag(spark, "returnRate", folder)) == {(2, "高")}


def test_staging_in_a_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS staging")
    s.stage_tag(tag(spark, (1, "低")), "returnRate", "staging", fmt="table")
    assert rows(s.read_staged_tag(spark, "returnRate", "staging", fmt="table")) == {(1, "低")}


def test_promote(spark, profile, tmp_path):
    folder = str(tmp_path)
    s.stage_tag(tag(spark, (1, "高"), (950, "中"), (951, "中"), (None, "中")), "returnRate", folder)
    known = spark.createDataFrame([("1",), ("950",)], "id string")
    found = s.promote_tag(spark, "returnRate", folder, profile, known=known)
    assert pairs(found, "id", "returnRate") == {"1": "高", "2": "高", "950": "中"}
    s.stage_tag(tag(spark, (951, "中")), "returnRate", folder)
    found = s.promote_tag(spark, "returnRate", folder, profile)
    assert pairs(found, "id", "returnRate") == {"1": "低", "2": "高", "951": "中"}


def test_write_and_read_the_profile(spark, profile, tmp_path):
    path = str(tmp_path / "profile")
    s.write_profile(profile, path, partitions=5)
    assert rows(s.read_profile(spark, path, ["returnRate"])) == {("1", "低"), ("2", "高")}
    assert s.read_profile(spark, path).columns == profile.columns
    with pytest.raises(AnalysisException):
        s.write_profile(profile, path)


def test_a_bucketed_profile_is_not_shuffled_by_an_upsert(spark, profile, tmp_path):
    s.write_profile(profile, str(tmp_path / "p"), partitions=8, table="wide_profile")
    stored = spark.table("wide_profile")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = s.upsert_tag(stored, tag(spark, (2, "中")), "returnRate")
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1
    assert pairs(merged, "id", "returnRate") == {"1": "低", "2": "中"}


def test_preview(spark):
    table = spark.range(50)
    assert s.preview(table, 5).count() == 5
    assert [r.id for r in s.preview(table, 3, ["id"]).collect()] == [0, 1, 2]


def test_checkpoints_lie_in_the_named_folder(spark):
    assert s.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    cut = s.checkpointed(spark.range(10).selectExpr("id * 2 AS x"))
    assert "ExistingRDD" in cut._jdf.queryExecution().executedPlan().toString()
    assert cut.count() == 10


def test_a_tag_goes_from_the_shop_table_to_the_profile(spark, tmp_path):
    path = str(tmp_path / "orders")
    orders(
        spark,
        {"memberId": "1", "orderAmount": "600000", "orderStatus": "202"},
        {"memberId": "2", "orderAmount": "600000", "orderStatus": "203"},
    ).write.parquet(path)
    table = s.load_orders(spark, path, ["memberId", "orderAmount", "orderStatus"])
    s.stage_tag(consumption.consumption_power(table), "consumptionPower", str(tmp_path))
    base = attribute.coded_tag(users(spark, {"id": "1", "gender": "1"}, {"id": "2"}), "gender")
    found = s.promote_tag(spark, "consumptionPower", str(tmp_path), base)
    assert rows(found) == {("1", "男", "超高"), ("2", "未知", None)}


def test_repeated_rows_of_a_tag_leave_one_profile_row(spark, profile):
    found = s.upsert_tag(profile, tag(spark, (1, "中"), (1, "高"), (1, None)), "returnRate")
    assert pairs(found, "id", "returnRate")["1"] == "高"


def test_a_bucketed_profile_has_a_file_per_bucket_and_is_not_shuffled_again(spark, tmp_path):
    rows = spark.range(0, 4000, numPartitions=20).selectExpr("cast(id AS string) AS id", "'x' AS returnRate")
    s.write_profile(rows, str(tmp_path / "p"), partitions=4, table="bucketed_profile")
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 4
    kept = s.read_profile(spark, table="bucketed_profile")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = spark.range(0, 10, numPartitions=3).selectExpr("cast(id AS string) AS id", "'y' AS returnRate")
        found = s.upsert_tag(kept, new, "returnRate")
        text = found._jdf.queryExecution().sparkPlan().toString()
        assert found.count() == 4000
        assert "bucketed_profile" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_profile")
