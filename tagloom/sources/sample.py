"""The shop tables expressed over the TPC-H-like sample tables.

Numbers and times keep their stored types, which every operator accepts beside
text, so that scans stay pruned and no value is formatted only to be parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import code_label
from ..tags.dictionaries import CATEGORIES
from .tables import load_table

# Order priority -> payment code of the sample orders.
PAYMENTS = {
    "1-URGENT": "alipay",
    "2-HIGH": "wxpay",
    "3-MEDIUM": "balance",
    "4-NOT SPECIFIED": "ccb",
}
# Browser texts given to sample page views by event number modulo seven.
AGENTS = {
    0: "Mozilla/5.0 (Windows NT 10.0; Win64; x64)",
    1: "Mozilla/5.0 (Linux; Android 9)",
    2: "Mozilla/5.0 (X11; Linux x86_64)",
    3: "Mozilla/5.0 (iPhone; CPU iPhone OS 13_0 like Mac OS X)",
    4: "Mozilla/5.0 (iPad; CPU OS 13_0 like Mac OS X)",
    5: "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15)",
}
# Number added to the sample brands, so that they meet the known brand codes.
BRAND_SHIFT = 296


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str, **aliases) -> DataFrame:
    return load_table(
        spark, f"{sf_dir}/{name}.parquet", [*columns, *aliases] or None, aliases
    )


def _digits(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders")
    status, sn = F.col("o_orderstatus"), F.col("o_orderkey")
    return raw.select(
        sn.alias("id"),
        F.col("o_custkey").alias("memberId"),
        sn.alias("orderSn"),
        F.col("o_totalprice").alias("orderAmount"),
        F.when(status == "F", "202")
        .when(status == "P", code_label(sn % 4, {0: "0", 1: "1", 2: "204"}, "201"))
        .when(status == "O", F.when(sn % 2 == 0, "203").otherwise("202"))
        .alias("orderStatus"),
        F.unix_timestamp("o_orderdate").alias("finishTime"),
        code_label(F.col("o_orderpriority"), PAYMENTS, "cod").alias("paymentCode"),
    )


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber")
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    line, name = F.col("l_linenumber"), F.col("p_name")
    category = code_label(
        F.col("p_size") % 22, {v: k for k, v in CATEGORIES.items()}, None
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 10 + line).alias("id"),
        F.col("l_orderkey").alias("orderId"),
        F.col("l_orderkey").alias("cOrderSn"),
        F.col("l_partkey").alias("productId"),
        F.when(line % 3 == 0, F.concat(name, F.lit(", set of "), line.cast("string")))
        .when(line % 3 == 1, name)
        .otherwise(F.concat(name, F.lit(" plus")))
        .alias("productName"),
        F.coalesce(category, F.col("p_type")).alias("productType"),
        (F.substring_index("p_brand", "#", -1).try_cast("int") + BRAND_SHIFT).alias("brandId"),
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    kind, event = F.col("event_type"), F.col("event_id")
    item = F.get_json_object("props", "$.k")
    return raw.select(
        event.alias("id"),
        F.col("user_id").alias("global_user_id"),
        F.col("ts").alias("log_time"),
        F.when(kind == "click", F.concat(F.lit("/product/"), item, F.lit(".html")))
        .when(kind == "view", F.concat(F.lit("/item/"), item, F.lit(".html")))
        .when(kind == "purchase", F.concat(F.lit("/order/"), event.cast("string")))
        .when(kind == "signup", F.lit("/login"))
        .otherwise(F.lit("http://www.eshop.com/"))
        .alias("loc_url"),
        F.when(event % 3 == 0, F.concat(F.lit("/itemlist/"), item, F.lit(".html")))
        .when(event % 3 == 1, F.lit("http://www.eshop.com/"))
        .alias("ref_url"),
        code_label(event % 7, AGENTS, "unknown").alias("user_agent"),
    )


def users(spark: SparkSession, sf_dir: str, last_login: bool = False) -> DataFrame:
    raw = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    key = F.col("c_custkey")
    base = raw.select(
        key.alias("id"),
        F.date_add(F.lit("1945-01-01").cast("date"), ((key * 37) % 30000).cast("int"))
        .cast("string")
        .alias("birthday"),
        *[
            (key % n).cast("string").alias(c)
            for c, n in (
                ("gender", 3),
                ("job", 8),
                ("marriage", 5),
                ("nationality", 6),
                ("politicalFace", 5),
            )
        ],
        F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("138"), _digits(F.col("c_nationkey"), 4), _digits(key % 10000, 4)).alias(
            "mobile"
        ),
        F.col("c_name").alias("username"),
    )
    if not last_login:
        return base
    seen = table(spark, sf_dir, "events", "user_id", "ts")
    newest = seen.groupBy(F.col("user_id").alias("id")).agg(
        F.max(F.unix_timestamp("ts")).alias("lastLoginTime")
    )
    return base.join(newest, "id", "left")


def prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mobile prefixes: one per nation; every fifth nation has an empty city."""
    nations = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    regions = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("138"), _digits(F.col("n_nationkey"), 4)).alias("prefix"),
        F.col("r_name").alias("province"),
        F.when(F.col("n_nationkey") % 5 == 0, F.lit("")).otherwise(F.col("n_name")).alias("city"),
    )


def prefixes_of_any_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mobile prefixes of three, six and seven digits; the longer ones begin with the shorter ones."""
    own = prefixes(spark, sf_dir)
    seven = own.where(F.substring("prefix", 7, 1).try_cast("int") % 2 == 0)
    six = own.groupBy(F.substring("prefix", 1, 6).alias("prefix")).agg(
        F.min("province").alias("province"), F.min(F.nullif("city", F.lit(""))).alias("city")
    )
    three = own.groupBy(F.substring("prefix", 1, 3).alias("prefix")).agg(
        F.max("province").alias("province"), F.max("city").alias("city")
    )
    return seven.unionByName(six).unionByName(three)


def users_abroad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users; some numbers have a country code before them, every seventh another country's."""
    number, key = F.col("mobile"), F.col("id")
    written = (
        F.when(key % 7 == 0, F.concat(F.lit("+1 "), number))
        .when(key % 3 == 0, F.concat(F.lit("+86"), number))
        .when(key % 3 == 1, F.concat(F.lit("0086 "), number))
        .otherwise(number)
    )
    return users(spark, sf_dir).withColumn("mobile", written)
