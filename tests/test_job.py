import pytest
from tests.helpers import goods, logs, orders, pairs, rows, users

from tagloom import job
from tagloom.sources import read_profile, read_staged_tag, schemas


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shop")
    tables = {
        "users": users(
            spark,
            {"id": "1", "gender": "1", "mobile": "13800010000", "birthday": "1990-05-05", "lastLoginTime": "9"},
            {"id": "2", "gender": "2", "email": "e"},
            {"id": "2000"},
        ),
        "orders": orders(
            spark,
            *[
                {"memberId": m, "orderSn": f"s{i}", "orderAmount": a, "orderStatus": s,
                 "finishTime": "1600000000", "paymentCode": "alipay"}
                for i, (m, a, s) in enumerate([("1", "600000", "202"), ("1001", "1", "0"), ("960", "5", "202")])
            ],
        ),
        "goods": goods(
            spark,
            {"cOrderSn": "s0", "productId": "1", "productName": "pan", "brandId": "297", "productType": "烤箱"},
            {"cOrderSn": "s0", "productId": "2", "productName": "pot", "brandId": "298", "productType": "滤芯"},
        ),
        "logs": logs(
            spark,
            *[
                {"global_user_id": str(u), "log_time": f"2020-01-01 0{u}:00:0{n}", "user_agent": "iPad",
                 "loc_url": f"/product/{1 + (u + n) % 2}.html"}
                for u in (1, 2, 3)
                for n in range(u)
            ],
            {"global_user_id": "3", "log_time": "2020-01-01 01:00:00", "loc_url": "/login"},
        ),
        "prefixes": spark.createDataFrame([("1380001", "广东", "深圳")], schemas.PREFIXES),
    }
    for name, table in tables.items():
        table.write.parquet(str(folder / name))
    return str(folder)


def start(spark, *argv):
    job.run(spark, job.parse([str(a) for a in argv]))


@pytest.mark.parametrize("tag", [t for t in job.JOBS if t != "PageBrowse"])
def test_every_job_gives_one_row_per_user(spark, shop, tag):
    found = job.JOBS[tag](job.Tables(spark, shop))
    assert found.columns[0] == "id" and dict(found.dtypes)["id"] == "string"
    assert found.count() == found.select("id").distinct().count() > 0


def test_the_profile_job_makes_every_tag_but_the_preferences(spark, shop):
    made = job.JOBS["profile"](job.Tables(spark, shop))
    tags = [t for t in schemas.PROFILE_TAGS if not t.startswith("favor")]
    assert made.columns == ["id", *tags]
    singles = {t: pairs(job.JOBS[t](job.Tables(spark, shop)), "id", t) for t in ("nativePlace", "deviceType")}
    for tag, expected in singles.items():
        assert pairs(made.where(f"{tag} IS NOT NULL"), "id", tag) == expected


def test_stage_then_promote(spark, shop, tmp_path):
    start(spark, "gender", "--tables", shop, "--out", tmp_path / "v1")
    start(spark, "consumptionPower", "--tables", shop, "--stage", tmp_path / "staged")
    staged = read_staged_tag(spark, "consumptionPower", str(tmp_path / "staged"))
    assert rows(staged) == {("1", "超高"), ("960", "很低")}
    start(
        spark, "consumptionPower", "--promote", tmp_path / "staged",
        "--profile", tmp_path / "v1", "--out", tmp_path / "v2",
    )
    found = read_profile(spark, str(tmp_path / "v2"))
    assert rows(found) == {("1", "男", "超高"), ("2", "女", None), ("2000", "未知", None), ("960", None, "很低")}


def test_add_to_a_profile(spark, shop, tmp_path):
    start(spark, "gender", "--tables", shop, "--out", tmp_path / "v1")
    start(spark, "favorBrand", "--tables", shop, "--profile", tmp_path / "v1", "--out", tmp_path / "v2")
    found = read_profile(spark, str(tmp_path / "v2"))
    assert found.columns == ["id", "gender", "favorBrand_0", "favorBrand_1"]
    assert set(pairs(found, "id", "gender")) == {"1", "2", "2000", "3"}
    assert read_profile(spark, str(tmp_path / "v1")).columns == ["id", "gender"]


def test_page_types_are_staged(spark, shop, tmp_path):
    start(spark, "PageBrowse", "--tables", shop, "--stage", tmp_path)
    assert rows(read_staged_tag(spark, "PageBrowse", str(tmp_path))) == {
        (1, 0, 0, 0, 1, 0), (2, 0, 0, 0, 2, 0), (3, 1, 0, 0, 3, 0),
    }


def test_promote_needs_a_profile(spark, shop, tmp_path):
    with pytest.raises(ValueError):
        start(spark, "gender", "--promote", tmp_path, "--out", tmp_path / "v")


def test_a_model_is_trained_once_and_mined_later(spark, shop, tmp_path, monkeypatch):
    models = tmp_path / "models"
    start(spark, "favorProductsModel", "--tables", shop, "--model", models)
    monkeypatch.setattr(job.als, "fit_als", lambda *a, **k: pytest.fail("fitted again"))
    start(spark, "favorProducts", "--model", models, "--out", tmp_path / "lists")
    lists = pairs(read_profile(spark, str(tmp_path / "lists")), "id", "favorProducts")
    assert set(lists) == {"1", "2", "3"} and set(lists["1"].split(",")) == {"1", "2"}
    # Users of the present ratings get lists without a fit.
    start(spark, "favorProducts", "--model", models, "--tables", shop, "--fold-in", "--out", tmp_path / "folded")
    assert pairs(read_profile(spark, str(tmp_path / "folded")), "id", "favorProducts") == lists
    with pytest.raises(ValueError):
        start(spark, "favorProductsModel", "--tables", shop)


def test_tags_staged_as_rows_are_promoted_together(spark, shop, tmp_path):
    start(spark, "gender", "--tables", shop, "--out", tmp_path / "v1")
    for tag in ("order_tags", "paymentMode"):
        start(spark, tag, "--tables", shop, "--stage-rows", tmp_path / "rows")
    start(
        spark, "many", "--promote-rows", tmp_path / "rows", "--tags", "consumptionPower,paymentMode",
        "--profile", tmp_path / "v1", "--out", tmp_path / "v2",
    )
    found = read_profile(spark, str(tmp_path / "v2"))
    assert found.columns == ["id", "gender", "consumptionPower", "paymentMode"]
    assert pairs(found, "id", "consumptionPower") == {"1": "超高", "2": None, "2000": None, "960": "很低"}


def test_reports_are_written(spark, shop, tmp_path):
    for name in job.REPORTS:
        start(spark, name, "--tables", shop, "--out", tmp_path / name)
    assert spark.read.parquet(str(tmp_path / "rfm")).count() == 3
    assert spark.read.parquet(str(tmp_path / "alsRmse")).columns == ["predictions", "rmse"]


def test_the_full_profile_has_all_columns(spark, shop):
    made = job.JOBS["fullProfile"](job.Tables(spark, shop))
    assert made.columns == ["id", *schemas.PROFILE_TAGS] and len(schemas.PROFILE_TAGS) == 43
    assert made.where("favorProducts IS NOT NULL").count() == 3


def test_what_is_staged_is_not_computed_again(spark, shop, tmp_path, monkeypatch):
    read = []
    monkeypatch.setattr(job, "read_staged_tag", lambda *a: read.append(a) or read_staged_tag(*a))
    start(spark, "gender", "--tables", shop, "--stage", tmp_path / "s", "--out", tmp_path / "v")
    assert read and rows(read_profile(spark, str(tmp_path / "v"))) == rows(read_staged_tag(spark, "gender", str(tmp_path / "s")))


def test_a_profile_by_table_name(spark, shop, tmp_path):
    spark.sql("DROP TABLE IF EXISTS profile_v1")
    start(spark, "gender", "--tables", shop, "--out", tmp_path / "v1", "--out-table", "profile_v1")
    start(spark, "job", "--tables", shop, "--profile-table", "profile_v1", "--out", tmp_path / "v2")
    assert read_profile(spark, str(tmp_path / "v2")).columns == ["id", "gender", "job"]
    spark.sql("DROP TABLE profile_v1")
