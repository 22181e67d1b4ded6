"""Orders and order lines stored so that they join without moving a row.

Both tables are bucketed by order number, so a join on it reads each bucket of both sides in one task. An
order with very many lines would fill one bucket: its lines are dealt over several parts, and its one order
row is stored once for each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of both tables; a multiple of the cores of a large cluster.
BUCKETS = 512
#: Lines of an order that one part holds.
LINES_PER_PART = 100_000
#: Column that tells the parts of an order apart.
PART = "order_part"


def write_colocated(
    orders: DataFrame,
    goods: DataFrame,
    database: str,
    path: str,
    buckets: int = BUCKETS,
    lines_per_part: int = LINES_PER_PART,
) -> None:
    """Save both tables below `path` as `database`.orders and `database`.goods.

    Order numbers are compared as text. Lines are counted by order, with partial counts; only orders beyond
    `lines_per_part` have more than one part. Orders without a number keep one part, as do lines.
    """
    sn = F.col("orderSn").cast("string")
    lines = goods.withColumn("orderSn", F.col("cOrderSn").cast("string"))
    many = lines.where(F.col("orderSn").isNotNull()).groupBy("orderSn").agg(F.count(F.lit(1)).alias("_lines"))
    many = many.where(F.col("_lines") > lines_per_part)
    parts = many.select("orderSn", F.ceil(F.col("_lines") / lines_per_part).cast("int").alias("_parts"))
    # The few long orders are the unique side; the lines, which may be hot, are the streamed one.
    dealt = lines.join(parts, "orderSn", "left")
    row = F.xxhash64(*[F.col(c) for c in goods.columns])
    spread = F.when(F.col("_parts") > 1, F.pmod(row, F.col("_parts"))).otherwise(F.lit(0)).cast("int")
    dealt = dealt.withColumn(PART, spread).select(*goods.columns, "orderSn", PART)
    repeated = orders.withColumn("orderSn", sn).join(parts, "orderSn", "left")
    numbers = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = repeated.withColumn(PART, F.explode(numbers)).select(*orders.columns, PART)
    for df, name in ((repeated, "orders"), (dealt, "goods")):
        # One task writes one bucket, and one file.
        writer = df.repartition(buckets, "orderSn", PART).write.format("parquet").mode("errorifexists")
        writer = writer.bucketBy(buckets, "orderSn", PART).sortBy("orderSn", PART)
        writer.option("path", f"{path}/{name}").saveAsTable(f"{database}.{name}")


def read_orders(spark: SparkSession, database: str) -> DataFrame:
    """The orders, each of them once."""
    return spark.table(f"{database}.orders").where(F.col(PART) == 0).drop(PART)


def read_goods(spark: SparkSession, database: str) -> DataFrame:
    """The order lines."""
    return spark.table(f"{database}.goods").drop("orderSn", PART)


def joined_lines(spark: SparkSession, database: str, order_columns, line_columns) -> DataFrame:
    """(orderSn, order_columns, line_columns): every line beside its order, without an exchange."""
    orders = spark.table(f"{database}.orders").select("orderSn", PART, *order_columns)
    goods = spark.table(f"{database}.goods").select("orderSn", PART, *line_columns)
    return goods.join(orders, ["orderSn", PART]).drop(PART)
