from pyspark.sql import functions as F
from tests.helpers import column

from tagloom import functions as f


def one(spark, kind, *values):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_bad_text_becomes_null(spark):
    df = one(spark, "string", "7", " 8", "x", "", None, "99999999999")
    assert column(df.select(f.whole_number(df, "x").alias("y")), "y") == [7, 8, None, None, None, None]
    assert column(df.select(f.whole_number(df, "x", "bigint").alias("y")), "y")[-1] == 99999999999
    df = one(spark, "string", "1.5", "x", None)
    assert column(df.select(f.number_value(df, "x").alias("y")), "y") == [1.5, None, None]


def test_whole_amount_cuts_the_fraction(spark):
    df = one(spark, "string", "12", "12.99", "-3.9", "bad", None, "99999999999")
    assert column(df.select(f.whole_amount(df, "x").alias("y")), "y") == [12, 12, -3, None, None, None]
    df = one(spark, "double", 12.99, -3.9, float("nan"), None)
    assert column(df.select(f.whole_amount(df, "x").alias("y")), "y")[:2] == [12, -3]


def test_integral_columns_keep_their_type(spark):
    df = one(spark, "bigint", 99999999999, None)
    assert column(df.select(f.whole_number(df, "x").alias("y")), "y") == [99999999999, None]


def test_times(spark):
    df = one(spark, "string", "1970-01-02 00:00:01", "1970-01-02", "bad", None)
    assert column(df.select(f.epoch_seconds(df, "x").alias("y")), "y") == [86401, None, None, None]
    df = one(spark, "string", "1990-1-5", "1990-01-05", "1990-01-05 10:00:00", "bad", "1990-13-01", None)
    days = column(df.select(f.calendar_date(df, "x").cast("string").alias("y")), "y")
    assert days == ["1990-01-05"] * 3 + [None] * 3


def test_member_user(spark):
    df = one(spark, "string", "7", "1007", "2007", "950", "951", "-5", None, "99999999999", "abc")
    assert column(df.select(f.member_user(df, "x").alias("y")), "y") == [
        7, 7, 7, 950, 951, -5, None, None, None,
    ]
    assert column(df.select(f.member_tail_user(df, "x").alias("y")), "y")[:6] == [
        7, 7, 7, 950, 951, -5,
    ]
    known = spark.createDataFrame([(7,), (950,)], "id int")
    kept = f.within(df.withColumn("id", f.member_user(df, "x")), known)
    assert sorted(column(kept, "x")) == ["1007", "2007", "7", "950"]
    assert f.within(df.withColumn("id", f.member_user(df, "x")), None).count() == 6


def test_code_label_compares_exactly(spark):
    df = one(spark, "string", "1", " 1", "01", "9", None)
    label = f.code_label(F.col("x"), {"1": "a", "2": "b"}, "z")
    assert column(df.select(label.alias("y")), "y") == ["a", "z", "z", "z", "z"]


def test_band_edges(spark):
    df = one(spark, "double", 9.99, 10.0, 10.01, None)
    loose = f.band(F.col("x"), [(10, "top")], "low")
    strict = f.band(F.col("x"), [(10, "top")], "low", strict=True)
    assert column(df.select(loose.alias("y")), "y") == ["low", "top", "top", "low"]
    assert column(df.select(strict.alias("y")), "y") == ["low", "low", "top", "low"]


def test_range_score_has_gaps(spark):
    df = one(spark, "double", 0.0, 1.0, 3.0, 3.5, 4.0, 99.0, None)
    score = f.range_score(F.col("x"), [(1, 3, 5), (4, None, 1)])
    assert column(df.select(score.alias("y")), "y") == [None, 5, 5, None, 1, 1, None]


def test_first_like_and_first_max(spark):
    df = one(spark, "string", "Android; Linux", "linux", None)
    label = f.first_like(F.col("x"), [("%Android%", "a"), ("%Linux%", "l")])
    assert column(df.select(label.alias("y")), "y") == ["a", None, None]
    df = spark.createDataFrame([(1, 2), (2, 2), (0, 0)], "a int, b int")
    top = f.first_max([("a", F.col("a")), ("b", F.col("b"))])
    assert column(df.select(top.alias("y")), "y") == ["b", "a", "a"]


def test_url_parts(spark):
    urls = {
        "/product/12.html": ("12", 12, "12"),
        "/product/12.html?x": ("12", 12, "12"),
        "/a.html/product/9.html": (None, None, "9"),
        "/product/.html": ("", None, ""),
        "/product/abc.html": ("abc", None, "abc"),
        "/product/7/b.html": ("7/b", None, "b"),
        "/product/12": (None, None, "12"),
        "/item/": (None, None, ""),
        "plain": (None, None, "plain"),
        None: (None, None, None),
    }
    df = one(spark, "string", *urls)
    text = f.product_id_from_url(F.col("x"))
    out = df.select(text, text.try_cast("int"), f.last_path_segment(F.col("x"))).collect()
    assert [tuple(r) for r in out] == list(urls.values())
