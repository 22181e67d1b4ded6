"""Personal data by patterns, checksums and context words (operator 6): DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.narrow import fresh
from tagloom.llm.spans import bound, running_totals


@dataclass(frozen=True)
class Kind:
    """One kind of data: what proposes a span, what confirms it, what speaks for it.

    hint: a literal or pattern without which the main pattern cannot match.
    score: of a span that its pattern and check let through; a context word nearby adds
    CONTEXT_SCORE. Spans below ACCEPTED are dropped, unless the kind is a base kind.
    """

    name: str
    pattern: str
    hint: str
    context: str
    score: float
    base: bool = True


#: Leftmost matches without overlap. Possessive parts and the look-behinds, which let a run be
#: tried from its first character only, keep the time linear in the text; they match the same spans.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        "e-?mail|contact|write|kontakt|courriel|correo",
        0.9,
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", r"\bip\b|address|server|host|login", 0.7),
    # Maximal runs of 14 to 19 digits; longer and shorter runs would be dropped anyway.
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])",
        "[0-9]",
        "card|visa|master|credit|karte|carte|tarjeta",
        0.8,
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", "phone|tel|call|mobile|fax", 0.8),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
        "iban|bank|account|konto|compte|cuenta",
        0.9,
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "-",
        "ssn|social security|tax id",
        0.4,
        base=False,
    ),
    # Credentials: their value must look random.
    Kind(
        "secret",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}+""",
        "(?i)password|passwd|secret|token|api_?key",
        "key|auth|login|credential|password",
        0.7,
        base=False,
    ),
    Kind("access", r"AKIA[A-Z0-9]{12,}+", "AKIA", "aws|key|access", 0.8, base=False),
    Kind(
        "hex",
        r"(?<![0-9a-zA-Z])[0-9a-f]{32,}+(?![0-9a-zA-Z])",
        "[0-9a-f]{32}",
        "key|token|secret|auth|password|credential",
        0.4,
        base=False,
    ),
)
CONTEXT_SCORE, ACCEPTED = 0.35, 0.7
#: Code points before and after a span in which context words are looked for, as far as the next spans of its kind.
BEFORE, AFTER = 40, 20
#: Distinct characters that a credential's value must have.
RANDOM = 8


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(found: Column) -> Column:
    backwards = F.reverse(_digits(found))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(backwards, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), add) % 10 == 0


def _mod97(found: Column) -> Column:
    plain = F.regexp_replace(found, r"\x20", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    rest = F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)
    return F.length(plain).between(15, 34) & (rest == 1)


def _confirmed(kind: Kind, found: Column) -> Column:
    """Whether a proposed span holds up."""
    if kind.name == "ip":
        return F.forall(F.split(found, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike(r"^(|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind.name == "card":
        return F.length(_digits(found)).between(14, 19) & _luhn(found)
    if kind.name == "phone":
        return F.length(_digits(found)).between(10, 15)
    if kind.name == "iban":
        return _mod97(found)
    if kind.name in ("secret", "access", "hex"):
        value = F.regexp_extract(found, "[A-Za-z0-9+/_.=-]+$", 0)
        return value.rlike("[0-9]") & (F.size(F.array_distinct(F.split(value, ""))) >= RANDOM)
    return F.lit(True)


_SPAN = "struct<start:int,rank:int,end:int,kind:string,score:double>"


def _found(kind: Kind, rank: int, text: Column) -> Column:
    """The confirmed matches of a kind as spans in code points, with their scores.

    A split by the pattern yields what lies between the matches. The running totals of both lengths are the
    places of the matches, and the ends of what lies before and after a match are its context, so no span
    looks at the text again.
    """

    def span(piece: Column) -> Column:
        around = F.concat(F.right(piece["before"], F.lit(BEFORE)), F.lit(" "), F.left(piece["after"], F.lit(AFTER)))
        near = F.lower(around).rlike(kind.context)
        score = F.least(F.lit(kind.score) + F.when(near, F.lit(CONTEXT_SCORE)).otherwise(F.lit(0.0)), F.lit(1.0))
        return F.struct(
            (piece["end"] - F.length(piece["found"])).alias("start"),
            F.lit(rank).alias("rank"),
            piece["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            score.alias("score"),
        )

    def spans(found: Column) -> Column:
        def placed(gaps: Column) -> Column:
            before, after = (F.slice(gaps, F.lit(i), F.size(found)) for i in (1, 2))
            ends = running_totals(F.zip_with(before, found, lambda g, f: F.length(g) + F.length(f)))
            pieces = F.arrays_zip(found.alias("found"), before.alias("before"), after.alias("after"), ends.alias("end"))
            return F.transform(F.filter(pieces, lambda p: _confirmed(kind, p["found"])), span)

        return bound(F.split(text, kind.pattern, -1), placed)

    listed = bound(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), spans)
    judged = listed if kind.base else F.filter(listed, lambda s: s["score"] >= ACCEPTED)
    hinted = F.contains(text, F.lit(kind.hint)) if kind.hint.isalpha() or len(kind.hint) == 1 else text.rlike(kind.hint)
    return F.when(hinted, judged).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: its other columns, and `found`, all spans by start, then kind.

    A span has start, rank of its kind, end (code points, exclusive), kind and score. Null texts
    are empty and have none. A column of `docs` called found is replaced.
    """
    names = [c for c in docs.columns if c.lower() != "found"]
    held = fresh(docs, "_text")
    rows = docs.select(*names, F.coalesce(F.col("text").cast("string"), F.lit("")).alias(held))
    spans = F.concat(*[_found(k, i, F.col(held)) for i, k in enumerate(KINDS)])
    return rows.select(*names, F.array_sort(spans).alias("found"))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """doc_id, the number of each base kind, the digest of the base spans, all spans and their scores.

    Text columns list kind:start:end by start, then kind, joined by commas; no span: an empty text.
    An empty table gives no rows; repeated rows and rows without an id are kept as they are.
    """
    base = [k.name for k in KINDS if k.base]
    found = personal_data(docs.select("doc_id", "text")).drop("text")
    kept = found.withColumn("base", F.filter("found", lambda s: s["kind"].isin(base)))
    return kept.select(
        "doc_id",
        *[_count("base", k).alias(f"n_{k}") for k in base],
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        F.concat_ws(",", F.transform("found", lambda s: F.format_number(s["score"], 2))).alias("scores"),
    )
