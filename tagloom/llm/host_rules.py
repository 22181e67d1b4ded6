"""Quality rules judged per document and per host (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textcols as T
from tagloom.llm.scratch import Scratch

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: A host whose shrunk failure rate of any rule is above this is rejected.
HOST_LIMIT = 0.5
#: Documents' worth of evidence in the prior: bounds of what the spread of hosts suggests.
LEAST_PRIOR, MOST_PRIOR = 5.0, 1000.0


def _repeated(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (row, value) pairs: whether the pair occurs twice or more; whether an earlier one equals it."""
    order = np.lexsort((np.arange(len(rows)), values, rows))
    r, v = rows[order], values[order]
    same = np.zeros(len(r) + 1, dtype=bool)
    same[1:-1] = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    later, twice = np.zeros(len(r), dtype=bool), np.zeros(len(r), dtype=bool)
    later[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return twice, later


def measured(part: T.Slice) -> dict[str, np.ndarray]:
    """Counts of every row of a slice, over its whole text."""
    n, data = len(part), part.data
    found = T.words(part)
    chars = np.concatenate([[0], np.cumsum(T.code_point_starts(data))])
    first, windows = T.window_hashes(found, T.byte_hashes(data, found.starts, found.ends), WINDOW)
    twice, _ = _repeated(found.rows[first], windows)
    cover = np.zeros(len(found.starts) + 1, dtype=np.int64)
    np.add.at(cover, first[twice], 1)
    np.add.at(cover, first[twice] + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0

    breaks = np.flatnonzero(data == 0x0A)
    # What follows a break at the end of a row is empty: no line of the next row.
    after = np.setdiff1d(breaks + 1, part.offsets)
    starts = np.union1d(part.offsets[:-1], after)
    starts = starts[starts < len(data)]
    line_row = np.searchsorted(part.offsets, starts, side="right") - 1
    next_break = np.concatenate([breaks, [len(data)]])[np.searchsorted(breaks, starts)]
    ends = np.minimum(next_break, part.offsets[line_row + 1])
    worded = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
    starts, ends, line_row = starts[worded], ends[worded], line_row[worded]
    _, later = _repeated(line_row, T.byte_hashes(data, starts, ends))

    symbol = np.zeros(256, dtype=bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    marks = np.concatenate([[0], np.cumsum(symbol[data])])
    return {
        "n_words": found.counts.astype(np.int64),
        "word_chars": T.sums_by_row(n, found.rows, chars[found.ends] - chars[found.starts]),
        "n_symbols": marks[part.offsets[1:]] - marks[part.offsets[:-1]],
        "n_dup_lines": T.sums_by_row(n, line_row, later.astype(np.int64)),
        "n_repeat_words": T.sums_by_row(n, found.rows, covered.astype(np.int64)),
        "n_lines": T.sums_by_row(n, line_row),
    }


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source and the counts of every document; null texts have no words."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(2)):
                ids = [batch.column(i).slice(part.first, len(part)) for i in (0, 1)]
                counts = measured(part)
                yield pa.RecordBatch.from_arrays(
                    ids + [pa.array(v.astype(np.int64)) for v in counts.values()], names=["doc_id", "source", *counts]
                )

    return docs.select("doc_id", F.col("source").cast("string"), F.col("text").cast("string")).mapInArrow(
        measure,
        f"doc_id {dict(docs.dtypes)['doc_id']}, source string, n_words long, word_chars long, n_symbols long,"
        " n_dup_lines long, n_repeat_words long, n_lines long",
    )


def rules() -> dict[str, Column]:
    """Each rule as a condition that holds where a document fails it."""
    c = F.col
    return {
        "too_short": c("n_words") < 10,
        "repetitive": c("n_repeat_words") * 100 > c("n_words") * 20,
        "symbols": c("n_symbols") * 10 > c("n_words"),
        "repeated_lines": c("n_dup_lines") * 100 > c("n_lines") * 30,
    }


def host_verdicts(judged: DataFrame, names: list[str], limit: float = HOST_LIMIT) -> DataFrame:
    """host, host_rejected, and the shrunk failure rate of each rule (`<rule>_rate`).

    Rates are shrunk to the rate of all documents by a beta prior. Its strength is fitted by the method of
    moments of the beta-binomial distribution: the spread of the hosts' own rates around the mean p is
    p (1 - p) / n by chance alone in a host of n documents, and what is beyond that, over 1 - 1 / n, is how far
    hosts really lie apart. Hosts count by their documents, as small ones tell little. Where hosts of one
    document are all there is, nothing can be told, and the prior is strongest; it never has less weight than
    LEAST_PRIOR documents: few documents alone do not condemn a host.
    """
    hosts = judged.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in names]
    )
    hosts = Scratch(judged.sparkSession, "hosts").keep(hosts)
    # One row each, whatever the number of hosts.
    mean = hosts.agg(*[(F.sum(r) / F.sum("n")).alias(r) for r in names]).first()
    mean = {r: float(mean[r] or 0.0) for r in names}
    spread = [F.sum(F.col("n") * F.pow(F.col(r) / F.col("n") - F.lit(mean[r]), 2)).alias(r) for r in names]
    spread = hosts.agg(*spread, F.count(F.lit(1)).alias("_hosts"), F.sum("n").alias("_docs")).first()
    docs = spread["_docs"] or 1
    chance = spread["_hosts"] / docs
    rated = hosts
    for r in names:
        p = mean[r]
        beyond = float(spread[r] or 0.0) / docs - p * (1 - p) * chance
        strength = MOST_PRIOR
        if beyond > 0 and chance < 1:
            strength = min(MOST_PRIOR, max(LEAST_PRIOR, p * (1 - p) * (1 - chance) / beyond - 1))
        rated = rated.withColumn(f"{r}_rate", (F.col(r) + F.lit(p * strength)) / (F.col("n") + F.lit(strength)))
    worst = F.greatest(*[F.col(f"{r}_rate") for r in names], F.lit(0.0))
    return rated.select("host", (worst > limit).alias("host_rejected"), *[f"{r}_rate" for r in names])


def host_rules(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per row of `docs`: its counts, base_failed and kept.

    kept is false where the document fails a base rule (fewer than 10 words, or more than a
    fifth of its words in repeated 5-word windows) or its host (`source`) is rejected.

    Null and empty texts have no words and fail. Rows without a source, or with an
    empty one, belong to one unnamed host. Repeated rows count as often as they occur. An
    empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "host-rules")
    tests = rules()
    judged = measures(docs).withColumn("host", F.coalesce("source", F.lit("")))
    judged = scratch.keep(judged.select("*", *[test.alias(r) for r, test in tests.items()]))
    verdicts = host_verdicts(judged, list(tests), limit).select("host", "host_rejected")
    base_failed = F.col("too_short") | F.col("repetitive")
    return judged.join(verdicts, "host", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~(base_failed | F.coalesce("host_rejected", F.lit(False)))).alias("kept"),
    )
