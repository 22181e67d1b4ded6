"""Staged tags and the wide profile: one row per id, one text column per tag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import within
from .schemas import TAG_PREFIX


def stage_tag(df: DataFrame, name: str, target: str, fmt: str = "parquet", **options) -> None:
    """Replace the staged table of tag `name` with `df`.

    `target` is a folder; with fmt "table" it is a database, and with "jdbc" the
    connection URL, whose further options the caller passes.
    """
    writer = df.write.mode("overwrite").options(**options)
    if fmt == "table":
        writer.saveAsTable(f"{target}.{TAG_PREFIX}{name}")
    elif fmt == "jdbc":
        writer.format("jdbc").option("url", target).option(
            "dbtable", TAG_PREFIX + name
        ).save()
    else:
        writer.format(fmt).save(f"{target}/{TAG_PREFIX}{name}")


def read_staged_tag(
    spark: SparkSession, name: str, target: str, fmt: str = "parquet", **options
) -> DataFrame:
    """The staged table of tag `name`; the arguments are those of `stage_tag`."""
    if fmt == "table":
        return spark.table(f"{target}.{TAG_PREFIX}{name}")
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        return reader.option("url", target).option("dbtable", TAG_PREFIX + name).load()
    return reader.load(f"{target}/{TAG_PREFIX}{name}")


def upsert_tags(
    profile: DataFrame, tags: DataFrame, names: Sequence[str], key: str = "id"
) -> DataFrame:
    """`profile` with the columns `names` replaced for every id of `tags`, in one join.

    A row of `tags` wins even where its value is null; other ids keep what they
    have, and new ids are added. Of several rows of an id in `tags` the greatest is
    taken, compared column by column, so that a profile row is never multiplied and its
    new values come from one row.
    """
    row = F.struct(*[F.col(n).cast("string").alias(n) for n in names])
    new = tags.groupBy(F.col(key).cast("string").alias(key)).agg(F.max(row).alias("_new"))
    merged = profile.join(new, key, "full")

    def value(name):
        if name not in names:
            return F.col(name)
        old = F.col(name) if name in profile.columns else F.lit(None).cast("string")
        return F.when(F.col("_new").isNotNull(), F.col("_new")[name]).otherwise(old).alias(name)

    added = [n for n in names if n not in profile.columns]
    return merged.select(*[value(n) for n in [*profile.columns, *added]])


def upsert_tag(profile: DataFrame, tag: DataFrame, name: str, key: str = "id") -> DataFrame:
    """`upsert_tags` of a single column."""
    return upsert_tags(profile, tag, [name], key)


#: Buckets of a profile that is saved as a table.
BUCKETS = 200


def write_profile(
    df: DataFrame,
    path: str,
    partitions: int | None = None,
    table: str | None = None,
    key: str = "id",
) -> None:
    """Write the profile to a new `path`; an existing one is never overwritten.

    `partitions` splits it by id. With `table` it is saved as a table bucketed
    and sorted by id, so that later upserts need not shuffle it.
    """
    if table is not None:
        partitions = partitions or BUCKETS  # one task writes one bucket, and one file
    out = df if partitions is None else df.repartition(partitions, key)
    writer = out.write.mode("errorifexists").format("parquet")
    if table is None:
        writer.save(path)
        return
    writer.bucketBy(partitions, key).sortBy(key).option("path", path).saveAsTable(table)


def read_profile(
    spark: SparkSession,
    path: str | None = None,
    tags: Sequence[str] | None = None,
    key: str = "id",
    table: str | None = None,
) -> DataFrame:
    """The id and the chosen tags of a written profile; by `table` it keeps its buckets."""
    profile = spark.table(table) if table is not None else spark.read.parquet(path)
    return profile if tags is None else profile.select(key, *tags)


#: Column that numbers the ranges of a profile that is split by id.
RANGE = "id_range"


def write_profile_ranges(df: DataFrame, path: str, ranges: int, key: str = "id") -> None:
    """Write the profile to a new `path`, split into `ranges` ranges of ids of about equal size.

    The bounds come from a sample that Spark takes of the ids, so that ids that lie close together, or begin
    alike, are split as evenly as others. Each range is a folder of its own; which ids it holds is stored
    beside the profile, so a reader of some ids opens the folders of their ranges alone.
    """
    split = df.repartitionByRange(ranges, key).withColumn(RANGE, F.spark_partition_id())
    split.sortWithinPartitions(key).write.mode("errorifexists").partitionBy(RANGE).parquet(f"{path}/profile")
    # A table without rows has no files, so its columns are kept apart.
    split.limit(0).write.mode("errorifexists").parquet(f"{path}/columns")
    written = df.sparkSession.read.schema(split.schema).parquet(f"{path}/profile")
    bounds = written.groupBy(RANGE).agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n"))
    bounds.coalesce(1).write.mode("errorifexists").parquet(f"{path}/ranges")


def read_profile_ranges(
    spark: SparkSession,
    path: str,
    ids: Sequence[str] | None = None,
    low: str | None = None,
    high: str | None = None,
    tags: Sequence[str] | None = None,
    key: str = "id",
) -> DataFrame:
    """The rows of some ids, or of the ids from `low` to `high` (both included), of a profile split by range.

    Only the folders of the ranges that may hold such ids are read. Ids are text and compared as text.
    """
    bounds = spark.read.parquet(f"{path}/ranges")
    columns = spark.read.parquet(f"{path}/columns").schema
    profile = spark.read.schema(columns).parquet(f"{path}/profile")
    wanted = F.lit(True)
    if ids is not None:
        wanted = wanted & F.exists(F.array(*[F.lit(i) for i in ids]).cast("array<string>"), lambda i: i.between(F.col("low"), F.col("high")))
        profile = profile.where(F.col(key).isin(list(ids)))
    if low is not None:
        wanted, profile = wanted & (F.col("high") >= low), profile.where(F.col(key) >= low)
    if high is not None:
        wanted, profile = wanted & (F.col("low") <= high), profile.where(F.col(key) <= high)
    # As many numbers as the profile has ranges at most.
    ranges = [r[RANGE] for r in bounds.where(wanted).select(RANGE).collect()]
    found = profile.where(F.col(RANGE).isin(ranges)).drop(RANGE)
    return found if tags is None else found.select(key, *tags)


def promote_tag(
    spark: SparkSession,
    name: str,
    target: str,
    profile: DataFrame,
    known: DataFrame | None = None,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """The profile after its column `name` took the staged tag.

    Every staged row is taken; with `known`, only those of its users.
    """
    staged = read_staged_tag(spark, name, target, fmt, **options)
    if known is not None:
        staged = within(staged.withColumn("id", F.col("id").try_cast("int")), known)
    return upsert_tag(profile, staged.select("id", name), name)


#: Columns of the long form of staged tags.
LONG_TAGS = ("id", "tag", "value", "staged_at")


def long_tags(tags: DataFrame, staged_at: Column, names: Sequence[str] | None = None, key: str = "id") -> DataFrame:
    """(id, tag, value, staged_at): one row per id and column of `tags`; a null value is a row too."""
    names = [c for c in tags.columns if c != key] if names is None else list(names)
    entries = [F.struct(F.lit(n).alias("tag"), F.col(n).cast("string").alias("value")) for n in names]
    return tags.select(
        F.col(key).cast("string").alias("id"),
        F.inline(F.array(*entries)),
        staged_at.cast("timestamp").alias("staged_at"),
    )


def stage_tags(df: DataFrame, target: str, staged_at: Column, names: Sequence[str] | None = None) -> None:
    """Append the columns of `df` to the staged rows at `target`, whatever is staged there already."""
    long_tags(df, staged_at, names).write.mode("append").parquet(target)


def newest_tags(staged: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per id of long staged rows: for each tag whether it was staged, and its newest value.

    The newest of several rows of an id and tag wins; of equally new ones the greatest value, a null value
    being the least. One aggregate with partial results, so one shuffle for any number of tags, and an id
    or tag with very many rows is no heavier than another. Rows of other tags are left out before it.
    """
    order = F.struct("staged_at", F.col("value").isNotNull().alias("some"), "value")
    newest = []
    for name in names:
        mine = F.col("tag") == name
        newest.append(F.max(F.when(mine, order)).alias(f"_new_{name}"))
    rows = staged.where(F.col("tag").isin(*names) & F.col("id").isNotNull())
    return rows.groupBy("id").agg(*newest)


def promote_tags(
    profile: DataFrame, staged: DataFrame, names: Sequence[str], known: DataFrame | None = None, key: str = "id"
) -> DataFrame:
    """The profile after all columns `names` took their newest staged values, in one join.

    `staged` has long rows (id, tag, value, staged_at). A tag that was staged for an id replaces the
    profile's value, by null as well; other tags and ids keep what they have, and new ids are added. With
    `known`, only rows of its users are taken.
    """
    if known is not None:
        staged = within(staged.withColumn("_user", F.col("id").try_cast("bigint")), known, "_user").drop("_user")
    new = newest_tags(staged, names).withColumnRenamed("id", key)
    merged = profile.join(new, key, "full")

    def value(name):
        old = F.col(name) if name in profile.columns else F.lit(None).cast("string")
        fresh = F.col(f"_new_{name}")
        return F.when(fresh.isNotNull(), fresh["value"]).otherwise(old).alias(name)

    added = [n for n in names if n not in profile.columns]
    columns = [value(c) if c in names else F.col(c) for c in profile.columns]
    return merged.select(*columns, *[value(n) for n in added])


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """The first `n` rows, in the order of `order_by` where given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
