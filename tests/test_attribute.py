import pytest
from tests.helpers import pairs, users

from tagloom.tags import attribute


@pytest.mark.parametrize(
    "tag, labels, other",
    [
        ("gender", ["男", "女"], "未知"),
        ("job", ["学生", "公务员", "军人", "警察", "教师", "白领"], "未知"),
        ("marriage", ["未婚", "已婚", "离异"], "未知"),
        ("nationality", ["中国大陆", "中国香港", "中国澳门", "中国台湾"], "其他"),
        ("politicalFace", ["群众", "党员", "无党派人士"], "其他"),
    ],
)
def test_coded_tags(spark, tag, labels, other):
    codes = [str(i + 1) for i in range(len(labels))]
    odd = ["0", " 1", "x", None]
    table = users(spark, *[{"id": str(i), tag: c} for i, c in enumerate([*codes, *odd])])
    found = pairs(attribute.coded_tag(table, tag), "id", tag)
    assert [found[str(i)] for i in range(len(codes) + len(odd))] == labels + [other] * len(odd)


def test_age_band(spark):
    births = {
        "2020-01-01": "20后",
        "2019-12-31": "10后",
        "2000-01-01": "00后",
        "1999-12-31": "90后",
        "1980-06-01": "80后",
        "1970-01-01": "70后",
        "1969-12-31": "60后",
        "1950-01-01": "50后",
        "1949-12-31": "其他",
        "bad": "其他",
        None: "其他",
    }
    table = users(spark, *[{"id": str(i), "birthday": b} for i, b in enumerate(births)])
    found = pairs(attribute.age_band(table), "id", "age")
    assert list(found.values()) == list(births.values())


SIGNS = [
    ("03-21", "04-19", "白羊座"),
    ("04-20", "05-20", "金牛座"),
    ("05-21", "06-21", "双子座"),
    ("06-22", "07-22", "巨蟹座"),
    ("07-23", "08-22", "狮子座"),
    ("08-23", "09-22", "处女座"),
    ("09-23", "10-23", "天秤座"),
    ("10-24", "11-22", "天蝎座"),
    ("11-23", "12-21", "射手座"),
    ("12-22", "01-19", "摩羯座"),
    ("01-20", "02-18", "水瓶座"),
    ("02-19", "03-20", "双鱼座"),
]


def test_constellation(spark):
    days = [(d, s) for first, last, s in SIGNS for d in (first, last)]
    days += [("02-29", "双鱼座"), ("12-31", "摩羯座"), ("01-01", "摩羯座")]
    table = users(spark, *[{"id": str(i), "birthday": f"2000-{d}"} for i, (d, _) in enumerate(days)])
    found = pairs(attribute.constellation(table), "id", "constellation")
    assert list(found.values()) == [s for _, s in days]


def test_missing_birthday_has_the_last_sign_unless_told(spark):
    table = users(spark, {"id": "1"}, {"id": "2", "birthday": "bad"})
    assert set(pairs(attribute.constellation(table), "id", "constellation").values()) == {"双鱼座"}
    named = attribute.constellation(table, null_label="未知")
    assert set(pairs(named, "id", "constellation").values()) == {"未知"}


def test_passthrough_and_all(spark):
    table = users(spark, {"id": "1", "email": "a@b", "mobile": "138", "username": "u", "gender": "1"})
    assert pairs(attribute.passthrough(table, "email"), "id", "email") == {"1": "a@b"}
    row = attribute.user_attributes(table).collect()[0]
    assert (row.gender, row.job, row.age, row.constellation) == ("男", "未知", "其他", "双鱼座")
    assert (row.email, row.mobile, row.username) == ("a@b", "138", "u")


def test_mobile_region(spark):
    table = users(
        spark,
        {"id": "1", "mobile": "13800010000"},
        {"id": "2", "mobile": "13800020000"},
        {"id": "3", "mobile": "13900000000"},
        {"id": "4"},
    )
    prefixes = spark.createDataFrame(
        [("1380001", "广东", "深圳"), ("1380001", "广东", "深圳"), ("1380002", "北京", "")],
        "prefix string, province string, city string",
    )
    city = attribute.mobile_region(table, prefixes, "city", "nativePlace")
    assert pairs(city, "id", "nativePlace") == {"1": "深圳", "2": "未知", "3": "未知", "4": "未知"}
    province = attribute.mobile_region(table, prefixes, "province", "nativeProvince")
    assert pairs(province, "id", "nativeProvince") == {
        "1": "广东", "2": "北京", "3": "未知", "4": "未知",
    }
