"""Secrets by patterns and by who else has them (operator 12): DataFrame functions only.

Patterns propose candidates. Their values, hashed, are counted over the whole corpus by distinct
repositories and distinct owners: a value that many owners hold is a copied example, one that only
its owner holds and that looks random is taken for a live credential.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.narrow import fresh
from tagloom.llm.scratch import Scratch
from tagloom.llm.spans import bound, running_totals


@dataclass(frozen=True)
class Kind:
    """One kind of secret.

    hint: a literal without which the pattern cannot match, or an empty text.
    value: group of the pattern that holds the secret itself.
    least: code points that the value must have.
    base: base spans are always listed; others only where they are taken for live.
    """

    name: str
    pattern: str
    hint: str
    value: int = 0
    least: int = 1
    base: bool = False


#: Leftmost matches without overlap. The look-behinds and least lengths drop only matches that would
#: fail anyway, and let a run be tried from its first character only.
KINDS = (
    Kind(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "",
        value=1,
        least=8,
        base=True,
    ),
    Kind("access", r"AKIA[A-Z0-9]{12,}", "AKIA", least=16, base=True),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", "", least=32, base=True),
    Kind("provider", r"(?<![A-Za-z0-9])(?:gh[pousr]_|glpat-|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16,}", ""),
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "eyJ"),
    Kind("bearer", r"Bearer\x20([A-Za-z0-9+/_.=-]{16,})", "Bearer", value=1),
    Kind("url", r"://[^\s/:@]{1,64}:([^\s/:@]{8,64})@", "://", value=1),
)
#: Owners from which on a value counts as widely copied.
COPIED_OWNERS = 3
#: A value looks live with that many distinct characters, some digit, and no word of an example.
LIVE_DISTINCT = 8
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]?|xxxx|test|12345678|abcdefgh"
#: Parts of each verdict in a join.
SALTS = 16

_SPAN = "struct<start:int,rank:int,end:int,kind:string,value:binary,live:boolean>"


def _looks_live(value: Column) -> Column:
    return (
        value.rlike("[0-9]")
        & ~value.rlike(PLACEHOLDER)
        & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_DISTINCT)
    )


def _proposed(kind: Kind, rank: int, text: Column) -> Column:
    """The matches of a kind that are long enough, as spans in code points.

    A split by the pattern yields what lies between the matches, so the running totals of both lengths
    are the places of the matches.
    """

    def span(piece: Column) -> Column:
        return F.struct(
            (piece["end"] - F.length(piece["found"])).alias("start"),
            F.lit(rank).alias("rank"),
            piece["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            # The value itself is never stored.
            F.unhex(F.md5(piece["value"].cast("binary"))).alias("value"),
            _looks_live(piece["value"]).alias("live"),
        )

    def spans(found: Column) -> Column:
        values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.value)) if kind.value else found
        gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found))
        ends = running_totals(F.zip_with(gaps, found, lambda g, f: F.length(g) + F.length(f)))
        pieces = F.arrays_zip(found.alias("found"), values.alias("value"), ends.alias("end"))
        return F.transform(F.filter(pieces, lambda p: F.length(p["value"]) >= kind.least), span)

    hinted = F.contains(text, F.lit(kind.hint)) if kind.hint else text.rlike(kind.pattern)
    proposed = bound(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), spans)
    return F.when(hinted, proposed).otherwise(F.array().cast(f"array<{_SPAN}>"))


def candidates(docs: DataFrame) -> DataFrame:
    """The other columns of `docs` and `found`, the candidates of a row by start, then kind.

    A candidate has start, rank of its kind, end (code points, exclusive), kind, value (a digest) and
    live (whether the value looks random). Null texts have none. A column called found is replaced.
    """
    names = [c for c in docs.columns if c.lower() not in ("found", "text")]
    held = fresh(docs, "_text")
    text = F.col(held)
    rows = docs.select(*names, F.coalesce(F.col("text").cast("string"), F.lit("")).alias(held))
    spans = F.concat(*[_proposed(k, i, text) for i, k in enumerate(KINDS)])
    return rows.select(*names, F.array_sort(spans).alias("found"))


def ownership(found: DataFrame, repository: str, owner: str) -> DataFrame:
    """(value, owners, repositories): how many distinct owners and repositories hold each candidate.

    `found` has the columns value, `repository` and `owner`; nulls count as one owner or repository.
    Holdings are made distinct before they are counted, so a value that a third of all rows hold is
    spread over its holders, and then moved as partial counts.
    """
    holdings = found.select("value", repository, owner).distinct()
    by_owner = holdings.groupBy("value", owner).agg(F.count(F.lit(1)).alias("_repositories"))
    return by_owner.groupBy("value").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("_repositories").alias("repositories")
    )


def secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id and `found`, the candidates of every row with owners and verdict.

    A candidate's verdict is copied (held by COPIED_OWNERS owners or more), live (not copied, and it
    looks random) or weak. Candidates are written once without any text; rows without one take no part
    in the joins. Nulls: see `candidates` and `ownership`. Repeated rows and rows without an id stay.
    """
    named = docs.select(
        "doc_id", F.col(repository).alias("repository"), F.col(owner).alias("owner"), "text"
    )
    scratch = Scratch(docs.sparkSession, "secrets")
    # The row number is stored with its row and does not change after that.
    rows = scratch.keep(candidates(named).withColumn("row", F.monotonically_increasing_id()))
    held = rows.where(F.size("found") > 0).select("row", "repository", "owner", F.posexplode("found").alias("at", "span"))
    copied = ownership(held.select(F.col("span.value").alias("value"), "repository", "owner"), "repository", "owner")
    copied = copied.where(F.col("owners") >= COPIED_OWNERS)
    # A value that very many rows hold is joined in parts.
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    parts = copied.select("value", "owners", "repositories", salts.alias("salt"))
    spans = held.select("row", "span", F.col("span.value").alias("value"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt"))
    joined = spans.join(parts, ["value", "salt"], "left")
    verdict = (
        F.when(F.col("owners").isNotNull(), "copied").when(F.col("span.live"), "live").otherwise("weak").alias("verdict")
    )
    judged = joined.select(
        "row", F.struct("span.start", "span.rank", "span.end", "span.kind", verdict, "owners", "repositories").alias("span")
    )
    by_row = judged.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("judged"))
    with_some = rows.where(F.size("found") > 0).select("row", "doc_id").join(by_row, "row")
    none = rows.where(F.size("found") == 0).select("doc_id", F.lit(None).cast(by_row.schema["judged"].dataType).alias("judged"))
    all_rows = with_some.select("doc_id", "judged").unionByName(none)
    empty = F.array().cast(by_row.schema["judged"].dataType)
    return all_rows.select("doc_id", F.coalesce("judged", empty).alias("found"))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def secrets_digest(docs: DataFrame) -> DataFrame:
    """doc_id, the number of each base kind, the digest of the base spans, all spans, and the verdicts.

    Added spans are listed where their verdict is live. `live` and `copied` list the spans with that
    verdict, base ones among them. An empty table gives no rows.
    """
    base = [k.name for k in KINDS if k.base]
    of_base = F.filter("found", lambda s: s["kind"].isin(base))
    listed = F.filter("found", lambda s: s["kind"].isin(base) | (s["verdict"] == "live"))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def judged(verdict):
        return _listed(F.filter("found", lambda s: s["verdict"] == verdict)).alias(verdict)

    return secrets(docs).select(
        "doc_id",
        *[count(k) for k in base],
        F.sha2(_listed(of_base).cast("binary"), 256).alias("base_sha256"),
        _listed(listed).alias("spans"),
        judged("live"),
        judged("copied"),
    )
