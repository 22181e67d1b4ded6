"""Passages that repeat across documents, by sliding spans of sentences (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textcols as T
from tagloom.llm.narrow import possible, residues
from tagloom.llm.scratch import Scratch

#: A span is the shortest run of sentences with so many words. Besides punctuation and line breaks, the least word
#: (by hash) of every WITHIN words that follow one another begins a sentence, so none is longer, and which words do depends on no others.
#: A repeated passage of SPAN_WORDS + 3 * WITHIN - 2 = 49 words with equal line breaks thus holds a whole span, wherever
#: it begins: a head lies in its first WITHIN words, and the heads where the span may end are the same in every copy.
SPAN_WORDS, WITHIN = 24, 9


def _sentences(part: T.Slice) -> tuple[T.Words, np.ndarray, np.ndarray]:
    """Words, their hashes, and the first word of every sentence (the number of words at the end)."""
    found = T.words(part)
    n = len(found.starts)
    low = T.lower_ascii(part.data)
    hashes = T.byte_hashes(low, found.starts, found.ends)
    ends = np.zeros(n, dtype=bool)
    if n:
        ends = np.isin(low[found.ends - 1], np.frombuffer(b".!?;:", dtype=np.uint8))
        breaks = np.concatenate([[0], np.cumsum(part.data == 0x0A)])
        following = np.append(found.starts[1:], len(part.data))
        ends |= breaks[following] > breaks[found.ends]
    first = np.concatenate([[True], ends[:-1]]) if n else ends
    first[found.bounds[:-1][found.bounds[:-1] < n]] = True
    if n >= WITHIN:
        # The least of every window inside a row, the last one of equals.
        value, count = T.mix64(hashes, 7), n - WITHIN + 1
        least, at = value[:count].copy(), np.arange(count)
        for j in range(1, WITHIN):
            now = value[j : count + j]
            lower = now <= least
            least[lower] = now[lower]
            at[lower] = np.flatnonzero(lower) + j
        rows = found.rows
        first[at[rows[:count] == rows[WITHIN - 1 :]]] = True
    return found, hashes, np.append(np.flatnonzero(first), n).astype(np.int64)


def _stops(heads: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Where the runs that begin with the sentences `index` end; beyond the row where there is none."""
    return np.maximum(np.searchsorted(heads, heads[index] + SPAN_WORDS), index + 2)


def _spans(part: T.Slice) -> dict[str, np.ndarray]:
    found, hashes, heads = _sentences(part)
    starts = heads[:-1]
    row = np.searchsorted(found.bounds, starts, side="right") - 1
    row_first = np.searchsorted(heads, found.bounds[row])
    row_end = np.searchsorted(heads, found.bounds[row + 1])
    index = np.arange(len(starts))
    stop = _stops(heads, index)
    whole = stop <= row_end
    index, stop, row, row_first = index[whole], stop[whole], row[whole], row_first[whole]
    a, b = heads[index], heads[stop]
    return {
        "row": row,
        "sentence": (index - row_first).astype(np.int32),
        "h1": T.span_hashes(hashes, a, b),
        "h2": T.span_hashes(T.mix64(hashes, 3), a, b),
    }


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, sentence (the first of the run), h1, h2: every run of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(1)):
                found = _spans(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)).take(pa.array(found["row"])),
                        pa.array(found["sentence"]),
                        pa.array(found["h1"].view(np.int64)),
                        pa.array(found["h2"].view(np.int64)),
                    ],
                    names=["doc_id", "sentence", "h1", "h2"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, sentence int, h1 long, h2 long"
    )


def without_repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_sentences, n_removed, removed: one row per row of `docs`.

    Every run of consecutive sentences is hashed and compared across the corpus; sentences
    that a run covers which is not its first occurrence (least doc_id, then place) are removed with the
    white space behind them. removed lists start:end in code points of the old text.

    Null and empty texts stay as they are, and so do rows without a doc_id. Rows that share a doc_id are copies
    of one document. An empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "spans")
    keyed = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("_doc"))
    # Runs are many times cheaper to hash again than to store or to shuffle with their places: one pass
    # counts the hashes alone, another one takes the places of those that repeat.
    runs = spans(keyed.where("doc_id IS NOT NULL"))
    repeated = scratch.keep(runs.select("h1").groupBy("h1").agg(F.count("*").alias("copies")).where("copies > 1").select("h1"))
    places = scratch.keep(possible(runs, residues(repeated, "h1"), "h1"))
    shared = (
        places.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies")).where("copies > 1")
    )
    shared = scratch.keep(shared.select("h1", "h2", "first_doc"))
    near = places.join(shared, ["h1", "h2"])
    later = near.where("doc_id <> first_doc").select("doc_id", "sentence")
    # Within the document of the first occurrence, later places go as well.
    own = near.where("doc_id = first_doc")
    place = own.groupBy("h1", "h2").agg(F.min("sentence").alias("first_sentence"))
    again = own.join(place, ["h1", "h2"]).where("sentence <> first_sentence").select("doc_id", "sentence")
    covered = later.unionByName(again).groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("sentence").alias("cover"))
    covered = scratch.keep(covered)
    gone = residues(covered, "_doc")
    touched = possible(keyed, gone, "_doc").join(covered, "_doc", "left").select("doc_id", "text", "cover")
    untouched = possible(keyed, gone, "_doc", within=False).select(
        "doc_id", "text", F.lit(None).cast("array<int>").alias("cover")
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, count, dropped, places = list(batch["text"]), [], [], []
            for part in T.slices(pa.array(batch["text"], pa.large_string())):
                found, _, heads = _sentences(part)
                lows = np.searchsorted(heads, found.bounds)
                chars = np.concatenate([[0], np.cumsum(T.code_point_starts(part.data))])
                for r in range(len(part)):
                    first, n = lows[r], lows[r + 1] - lows[r]
                    out = np.zeros(n + 1, dtype=np.int64)
                    cover = batch["cover"].iloc[part.first + r]
                    begun = np.asarray(cover if cover is not None else (), dtype=np.int64)
                    begun = begun[begun < n]
                    np.add.at(out, begun, 1)
                    np.add.at(out, np.minimum(_stops(heads, first + begun) - first, n), -1)
                    gone = np.cumsum(out[:-1]) > 0
                    count.append(int(n))
                    dropped.append(int(gone.sum()))
                    if not gone.any():
                        places.append("")
                        continue
                    begin = found.starts[heads[first : first + n]]
                    bounds = np.append(begin, part.offsets[r + 1])
                    kept = [part.data[part.offsets[r] : begin[0]].tobytes()]
                    kept += [part.data[bounds[i] : bounds[i + 1]].tobytes() for i in range(n) if not gone[i]]
                    texts[part.first + r] = b"".join(kept).decode()
                    at = chars[bounds] - chars[part.offsets[r]]
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    places.append(",".join(f"{at[a]}:{at[b]}" for a, b in edges.reshape(-1, 2)))
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "text": texts, "n_sentences": count, "n_removed": dropped, "removed": places}
            )

    kind = dict(docs.dtypes)["doc_id"]
    return touched.unionByName(untouched).mapInPandas(
        cut, f"doc_id {kind}, text string, n_sentences int, n_removed int, removed string"
    )
