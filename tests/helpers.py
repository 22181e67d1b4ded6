"""Small tables of text, as the shop stores them."""

from __future__ import annotations

from tagloom.sources import schemas


def _make(spark, schema, rows):
    names = schema.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def users(spark, *rows):
    return _make(spark, schemas.USERS, rows)


def logs(spark, *rows):
    return _make(spark, schemas.LOGS, rows)


def orders(spark, *rows):
    return _make(spark, schemas.ORDERS, rows)


def goods(spark, *rows):
    return _make(spark, schemas.GOODS, rows)


def column(df, name):
    """Values of one column in row order."""
    return [r[name] for r in df.select(name).collect()]


def pairs(df, key, value):
    """{key: value}; fails on a repeated key."""
    rows = df.select(key, value).collect()
    found = {r[0]: r[1] for r in rows}
    assert len(found) == len(rows), "repeated keys"
    return found


def rows(df):
    """The rows as a set of tuples; fails on repeated rows."""
    listed = [tuple(r) for r in df.collect()]
    assert len(set(listed)) == len(listed), "repeated rows"
    return set(listed)
