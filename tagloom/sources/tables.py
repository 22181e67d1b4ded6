"""Pruned reads of the shop tables, with the types they are stored in.

Each loader takes one folder, or several whose types may differ.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


def _stored_schema(spark: SparkSession, path: str, fmt: str, known: T.StructType | None) -> T.StructType:
    """What is stored at `path`; formats that store no types have the known columns as text."""
    if fmt in ("parquet", "orc", "table"):
        stored = spark.table(path).schema if fmt == "table" else spark.read.format(fmt).load(path).schema
        return T.StructType([T.StructField(f.name, f.dataType) for f in stored])
    return known if known is not None else spark.read.format(fmt).load(path).schema


def load_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    aliases: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """`columns` of the table at `path`, with the types they are stored in.

    `aliases` maps an output name to the stored column it is read from; other names are stored as they are
    called. `schema` lists the columns that the table should have: one that is not stored is null, as the
    type `schema` gives it or as text. Nothing is cast, so filters reach the scan.
    """
    aliases = dict(aliases or {})
    stored = _stored_schema(spark, path, fmt, schema)
    wanted = list(columns) if columns is not None else None
    if wanted is None:
        names = stored.names if schema is None else schema.names
        wanted = [*names, *(a for a in aliases if a not in names)]
    have, known = set(stored.names), {f.name: f.dataType for f in schema or []}
    sources = [aliases.get(c, c) for c in wanted]
    reader = spark.read.format(fmt)
    if fmt != "table":
        reader = reader.schema(T.StructType([f for f in stored if f.name in sources]))
    table = spark.table(path) if fmt == "table" else reader.load(path)

    def read(name: str, source: str) -> Column:
        if source in have or schema is None:
            return F.col(source).alias(name)
        return F.lit(None).cast(known.get(source, T.StringType())).alias(name)

    return table.select(*[read(c, s) for c, s in zip(wanted, sources)])


#: Number types from the narrowest to the widest.
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """The type that values of all `kinds` can be read as without losing any; text where there is no other."""
    kinds = [k for k in kinds if not isinstance(k, T.NullType)]
    if not kinds:
        return T.StringType()
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    if all(isinstance(k, _NUMBERS) for k in kinds):
        whole = [k for k in kinds if isinstance(k, T.IntegralType)]
        if len(whole) == len(kinds):
            return max(kinds, key=lambda k: _NUMBERS.index(type(k)))
        # Whole numbers of up to 32 bits fit into a double; longer ones would lose digits.
        return T.StringType() if any(isinstance(k, T.LongType) for k in whole) else T.DoubleType()
    if all(isinstance(k, T.DecimalType) or isinstance(k, T.IntegralType) for k in kinds):
        scale = max(getattr(k, "scale", 0) for k in kinds)
        before = max((k.precision - k.scale) if isinstance(k, T.DecimalType) else 19 for k in kinds)
        return T.DecimalType(before + scale, scale) if before + scale <= 38 else T.StringType()
    return T.StringType()


def load_unified(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str] | None = None,
    aliases: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """One table from folders that may store the same column in different types.

    Each folder's schema is read once. A column takes the type that all folders' values fit into, and is cast
    only in folders that store another; a filter on a column of one type still reaches every scan. A column
    that some folder does not store is null there.
    """
    tables = [load_table(spark, p, columns, aliases, schema, fmt) for p in paths]
    names = list(dict.fromkeys(c for t in tables for c in t.columns))
    kinds = {n: common_type([t.schema[n].dataType for t in tables if n in t.columns]) for n in names}

    def column(table: DataFrame, name: str) -> Column:
        if name not in table.columns:
            return F.lit(None).cast(kinds[name]).alias(name)
        same = table.schema[name].dataType == kinds[name]
        return F.col(name) if same else F.col(name).cast(kinds[name]).alias(name)

    return reduce(DataFrame.unionByName, [t.select(*[column(t, n) for n in names]) for t in tables])


def _load(spark, path, columns, aliases, schema) -> DataFrame:
    if isinstance(path, str):
        return load_table(spark, path, columns, aliases, schema)
    return load_unified(spark, path, columns, aliases, schema)


def load_users(spark, path, columns=None, aliases=None) -> DataFrame:
    """One row per user."""
    return _load(spark, path, columns, aliases, schemas.USERS)


def load_orders(spark, path, columns=None, aliases=None) -> DataFrame:
    """One row per order."""
    return _load(spark, path, columns, aliases, schemas.ORDERS)


def load_goods(spark, path, columns=None, aliases=None) -> DataFrame:
    """One row per order line."""
    return _load(spark, path, columns, aliases, schemas.GOODS)


def load_logs(spark, path, columns=None, aliases=None) -> DataFrame:
    """One row per page view."""
    return _load(spark, path, columns, aliases, schemas.LOGS)
