"""Quality classifier: a sparse ensemble of rules over text statistics (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textcols as T
from tagloom.llm.host_rules import _repeated, measured
from tagloom.llm.scratch import Scratch

#: Most labelled rows that the model is fitted on; the sample is the rows of least hash.
SAMPLE = 20_000
THRESHOLD = 0.7
TREES, DEPTH, LEARNING_RATE, LASSO = 30, 3, 0.3, 0.002

STATISTICS = (
    "words", "word_length", "longest_word", "symbols", "uppercase", "digits", "exclamations", "bars",
    "stops", "lines", "repeated_windows", "repeated_lines", "same_as_previous", "distinct_words",
)


def statistics(part: T.Slice) -> dict[str, np.ndarray]:
    """The statistics of every row of a slice, from its whole text; empty texts have zeros."""
    n, data = len(part), part.data
    counts = {k: v.astype(np.float64) for k, v in measured(part).items()}
    found = T.words(part)
    hashes = T.byte_hashes(data, found.starts, found.ends)
    rows = found.rows
    words, chars = np.maximum(counts["n_words"], 1), np.maximum(counts["word_chars"], 1)

    def share(low: str, high: str) -> np.ndarray:
        held = np.concatenate([[0], np.cumsum((data >= ord(low)) & (data <= ord(high)))])
        return (held[part.offsets[1:]] - held[part.offsets[:-1]]) / chars

    same = np.zeros(len(rows), dtype=np.int64)
    same[1:] = (rows[1:] == rows[:-1]) & (hashes[1:] == hashes[:-1])
    _, later = _repeated(rows, hashes)
    longest = np.zeros(n)
    np.maximum.at(longest, rows, (found.ends - found.starts).astype(np.float64))
    return {
        "words": np.log1p(counts["n_words"]),
        "word_length": counts["word_chars"] / words,
        "longest_word": longest,
        "symbols": counts["n_symbols"] / words,
        "uppercase": share("A", "Z"),
        "digits": share("0", "9"),
        "exclamations": share("!", "!"),
        "bars": share("|", "|"),
        "stops": share(".", "."),
        "lines": counts["n_lines"] / words,
        "repeated_windows": counts["n_repeat_words"] / words,
        "repeated_lines": counts["n_dup_lines"] / np.maximum(counts["n_lines"], 1),
        "same_as_previous": T.sums_by_row(n, rows, same) / words,
        "distinct_words": T.sums_by_row(n, rows, 1 - later.astype(np.int64)) / words,
    }


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row of `docs`."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(1)):
                found = statistics(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(part)), *[pa.array(found[s]) for s in STATISTICS]],
                    names=["doc_id", *STATISTICS],
                )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"{s} double" for s in STATISTICS)
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(T.frugal(measure), schema)


Rule = tuple[tuple[str, bool, float], ...]


def _grow(x: np.ndarray, target: np.ndarray, path: Rule, rows: np.ndarray, rules: set, out: np.ndarray) -> None:
    """A regression tree on `target`; adds the path to every node and the means of the leaves."""
    if path:
        rules.add(tuple(sorted(path)))
    best = None
    if len(path) < DEPTH and len(rows) >= 20:
        own = target[rows]
        for j in range(x.shape[1]):
            order = np.argsort(x[rows, j], kind="stable")
            v, s = x[rows, j][order], np.cumsum(own[order])
            k = np.arange(1, len(rows))
            gain = s[:-1] ** 2 / k + (s[-1] - s[:-1]) ** 2 / (len(rows) - k)
            gain[(v[1:] == v[:-1]) | (k < 5) | (k > len(rows) - 5)] = -1
            i = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[i] > 0 and (best is None or gain[i] > best[0] + 1e-9):
                best = (gain[i], j, (v[i] + v[i + 1]) / 2)
        if best and best[0] - own.sum() ** 2 / len(rows) < 1e-9:
            best = None
    if best is None:
        out[rows] = target[rows].mean() if len(rows) else 0.0
        return
    _, j, cut = best
    below = x[rows, j] <= cut
    _grow(x, target, (*path, (STATISTICS[j], True, float(cut))), rows[below], rules, out)
    _grow(x, target, (*path, (STATISTICS[j], False, float(cut))), rows[~below], rules, out)


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, weighted rules) of labels y: boosted trees give the rules, a lasso their weights."""
    if not len(y) or y.min() == y.max():
        return (0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1)), []
    rules: set = set()
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(TREES):
        step = np.zeros(len(y))
        _grow(x, y - 1 / (1 + np.exp(-margin)), (), np.arange(len(y)), rules, step)
        margin += LEARNING_RATE * 4 * step
    listed = sorted(rules)
    at = {s: i for i, s in enumerate(STATISTICS)}
    held = [np.logical_and.reduce([(x[:, at[s]] <= c) == low for s, low, c in r]) for r in listed]
    z = np.column_stack([np.ones(len(y)), *held]).astype(np.float64)
    weight, ahead, t = np.zeros(z.shape[1]), np.zeros(z.shape[1]), 1.0
    rate = 4 * len(y) / max(np.linalg.eigvalsh(z.T @ z)[-1], 1e-9)
    for _ in range(1500):  # accelerated proximal gradient; the intercept is free
        slope = z.T @ (1 / (1 + np.exp(-(z @ ahead))) - y) / len(y)
        now = ahead - rate * slope
        now[1:] = np.sign(now[1:]) * np.maximum(np.abs(now[1:]) - rate * LASSO, 0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, weight, t = now + (t - 1) / after * (now - weight), now, after
    return float(weight[0]), [(r, float(w)) for r, w in zip(listed, weight[1:]) if abs(w) > 1e-6]


def compiled(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The score as one Spark column over the statistics."""
    total = F.lit(intercept)
    for rule, weight in rules:
        tests = [(F.col(s) <= c) if low else (F.col(s) > c) for s, low, c in rule]
        total = total + F.when(reduce(lambda a, b: a & b, tests), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.7): one row per row of `docs`.

    The model is fitted on at most `sample` labelled documents that are not held out; a document with
    several labels has the majority's. Null labels and ids are not learnt from; without
    labels the score is 0.5. Null and empty texts are scored by their statistics, all zero. Repeated
    rows have equal scores; an empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "rule-ensemble")
    known = scratch.keep(with_statistics(docs))
    chosen = (
        labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
        .where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("double").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most `sample` rows of numbers (repeated documents count once).
    rows = known.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("quality", *STATISTICS, "doc_id")
    table = np.array([r[:-1] for r in sorted(rows.collect(), key=lambda r: r[-1])], dtype=np.float64)
    table = table.reshape(-1, 1 + len(STATISTICS))
    score = compiled(*fit(table[:, 1:], table[:, 0]))
    return known.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` that are predicted good, all columns kept."""
    from tagloom.llm.narrow import possible, residues

    scratch = Scratch(docs.sparkSession, "rejected")
    rejected = scratch.keep(scored(docs, labels, sample).where("predicted = 0").select("doc_id").distinct())
    gone, names = residues(rejected, "doc_id"), docs.columns
    near = possible(docs, gone, "doc_id").alias("d")
    near = near.join(rejected.alias("r"), F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")), "left_anti")
    return near.select(names).unionByName(possible(docs, gone, "doc_id", within=False))
