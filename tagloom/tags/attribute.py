"""Tags read off the user row; none of them shuffles the users."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import band, calendar_date, code_label
from ..operators import one_per_key
from . import dictionaries as d

# Tag -> (labels, label of any other code); the column has the name of the tag.
CODE_TAGS = {
    "gender": (d.GENDER, d.UNKNOWN),
    "job": (d.JOB, d.UNKNOWN),
    "marriage": (d.MARRIAGE, d.UNKNOWN),
    "nationality": (d.NATIONALITY, d.OTHER),
    "politicalFace": (d.POLITICAL_FACE, d.OTHER),
}
COPIED_TAGS = ("email", "mobile", "username")


def _id() -> Column:
    return F.col("id").cast("string").alias("id")


def coded_tag(
    users: DataFrame, tag: str, labels: Mapping | None = None, default: str | None = None
) -> DataFrame:
    """Label of the code in column `tag`."""
    known, other = CODE_TAGS.get(tag, ({}, d.UNKNOWN))
    label = code_label(
        F.col(tag), known if labels is None else labels, other if default is None else default
    )
    return users.select(_id(), label.alias(tag))


def passthrough(users: DataFrame, tag: str) -> DataFrame:
    """Column `tag` as it is."""
    return users.select(_id(), tag)


def _decade(users: DataFrame, birthday: str) -> Column:
    return band(F.year(calendar_date(users, birthday)), d.BIRTH_DECADES, d.OTHER)


def _sign(users: DataFrame, birthday: str, null_label: str | None) -> Column:
    born = calendar_date(users, birthday)
    day = F.month(born) * 100 + F.dayofmonth(born)
    sign = band(day, d.STAR_SIGNS, d.LAST_STAR_SIGN)
    return sign if null_label is None else F.when(born.isNull(), null_label).otherwise(sign)


def age_band(users: DataFrame, birthday: str = "birthday") -> DataFrame:
    """Decade of birth."""
    return users.select(_id(), _decade(users, birthday).alias("age"))


def constellation(
    users: DataFrame, birthday: str = "birthday", null_label: str | None = None
) -> DataFrame:
    """Star sign; a missing or bad birthday counts as the last sign unless `null_label`."""
    return users.select(_id(), _sign(users, birthday, null_label).alias("constellation"))


def mobile_region(
    users: DataFrame, prefixes: DataFrame, part: str, tag: str, digits: int = 7
) -> DataFrame:
    """City or province (`part`) of the mobile number, by its first digits.

    `prefixes` is made unique by prefix first. Spark broadcasts it where its size
    allows, and otherwise shuffles both sides.
    """
    return mobile_regions(users, prefixes, {tag: part}, digits)


def mobile_regions(
    users: DataFrame, prefixes: DataFrame, parts: Mapping[str, str], digits: int = 7
) -> DataFrame:
    """Several tags from one join: `parts` maps each tag to its prefix column."""
    regions = one_per_key(
        prefixes, "prefix", *[F.min(part).alias(f"_{tag}") for tag, part in parts.items()]
    )
    keyed = users.withColumn("prefix", F.substring("mobile", 1, digits))
    joined = keyed.join(regions, "prefix", "left")
    return joined.select(
        _id(),
        *[
            F.coalesce(F.nullif(F.col(f"_{tag}"), F.lit("")), F.lit(d.UNKNOWN)).alias(tag)
            for tag in parts
        ],
    )


def longest_prefix_regions(
    users: DataFrame,
    prefixes: DataFrame,
    parts: Mapping[str, str],
    lengths: Sequence[int] = tuple(range(3, 10)),
    country: str | None = "86",
) -> DataFrame:
    """As `mobile_regions`, by the longest of the prefixes that the number begins with.

    Prefixes may have any of the given lengths. A number is looked up without its "+", its zeros of an
    international call and, where it is written before the number, the code of its own `country`; prefixes
    are written without them. Every user meets a prefix through one equi-join on the text of the prefix: the
    prefixes that a number could have are listed beside it, the wanted ones are found by the join, and the
    longest of a user's hits is kept by a partial aggregate. A prefix that very many users share is the
    looked-up, unique side. Users are told apart by their row, so repeated ids stay.
    """
    found = [F.min(part).alias(f"_{tag}") for tag, part in parts.items()]
    regions = one_per_key(prefixes.where(F.length("prefix").isin(*lengths)), "prefix", *found)
    digits = F.regexp_replace(F.col("mobile").cast("string"), "[^0-9+]", "")
    number = F.regexp_replace(digits, r"^(\+|00)", "+")
    if country:
        number = F.regexp_replace(number, rf"^\+{country}", "")
    number = F.regexp_replace(number, r"^\+", "")
    # Numbers repeat in few texts as compared with users, so they are made distinct before the join.
    numbers = users.select(F.col("mobile").cast("string").alias("_mobile"), number.alias("_number"))
    numbers = numbers.where(F.col("_mobile").isNotNull()).distinct()
    starts = F.explode(F.array(*[F.substring("_number", 1, n) for n in sorted(lengths)]))
    longest = F.max(F.struct(F.length("prefix").alias("_length"), *[F.col(f"_{tag}") for tag in parts]))
    hits = numbers.select("_mobile", starts.alias("prefix")).distinct().join(regions, "prefix")
    best = hits.groupBy("_mobile", F.xxhash64("_mobile").alias("_digest")).agg(longest.alias("_best")).drop("_digest")
    keyed = users.withColumn("_mobile", F.col("mobile").cast("string"))
    joined = keyed.join(best, "_mobile", "left")
    return joined.select(
        _id(),
        *[
            F.coalesce(F.nullif(F.col("_best")[f"_{tag}"], F.lit("")), F.lit(d.UNKNOWN)).alias(tag)
            for tag in parts
        ],
    )


def user_attributes(users: DataFrame) -> DataFrame:
    """Every tag of this module that needs nothing but the user row, in one projection."""
    return users.select(
        _id(),
        *[
            code_label(F.col(tag), labels, other).alias(tag)
            for tag, (labels, other) in CODE_TAGS.items()
        ],
        _decade(users, "birthday").alias("age"),
        _sign(users, "birthday", None).alias("constellation"),
        *COPIED_TAGS,
    )
