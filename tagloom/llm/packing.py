"""Packing documents into sequences with their nearest neighbours (operator 2)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm import textcols as T
from tagloom.llm.bpe import encoder
from tagloom.llm.scratch import Scratch

WINDOW, END_ID = 2048, 1
#: Tokens of a shard of the index: what one task holds at a time, whatever the size of the corpus.
SHARD_TOKENS = 1 << 20
#: Beyond every id of the vocabulary.
NO_TERM = 1 << 16
K1, B = 1.2, 0.75
#: The ranks of the vocabulary; the file of this name with .json is the tokenizer that the ids are those of.
VOCABULARY = "byte_bpe_50k.tiktoken"


def tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids (unsigned 16-bit): ids of the whole text and the end id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        coder = encoder(public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
        end = np.array([END_ID], dtype=np.uint16)
        for batch in batches:
            for part in T.slices(batch.column(1)):
                rows = [np.concatenate([r, end]) for r in coder.rows(part)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        pa.array([len(r) for r in rows], pa.int64()),
                        pa.array([r.astype("<u2").tobytes() for r in rows], pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        T.frugal(encode), f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids binary"
    )


def frequencies(rows: DataFrame) -> np.ndarray:
    """In how many documents each id occurs; at most 65,536 numbers, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for _, _, term, _, _ in _distinct([np.frombuffer(ids.as_buffer(), dtype="<u2") for ids in batch.column(0)]):
                seen += np.bincount(term, minlength=1 << 16)
        terms = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int64)), pa.array(seen[terms])], names=["term", "n"])

    found = rows.select("ids").mapInArrow(T.frugal(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(1 << 16, dtype=np.int64)
    for r in found:
        out[r.term] = r.n
    return out


def _distinct(lists: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(begin, end, term, document, times) of so many documents at a time that the arrays stay small.

    Each distinct term of each document once, by document and term; documents are numbered from `begin`.
    """
    size = np.array([len(x) for x in lists], dtype=np.int64)
    piece = (np.cumsum(size) - size) >> 18
    for begin, end in zip(*(np.searchsorted(piece, np.unique(piece), side) for side in ("left", "right"))):
        owner = np.repeat(np.arange(end - begin, dtype=np.uint32), size[begin:end])
        both = np.sort(owner << np.uint32(16) | np.concatenate(lists[begin:end]))
        first = np.flatnonzero(np.concatenate([np.ones(min(len(both), 1), dtype=bool), both[1:] != both[:-1]]))
        times = np.diff(np.append(first, len(both)))
        yield begin, end, (both[first] & np.uint32(0xFFFF)).astype(np.int64), (both[first] >> np.uint32(16)).astype(np.int64), times


def _bm25(term: np.ndarray, times: np.ndarray, size: np.ndarray, idf: np.ndarray, mean: float) -> np.ndarray:
    """The BM25 weights of terms that occur so many times in documents of such sizes."""
    return idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * size / mean))


def _keys(rows: pa.Array, idf: np.ndarray, mean: float, shared: np.ndarray) -> np.ndarray:
    """The two heaviest terms of each document among those of `shared`; NO_TERM where there are fewer."""
    lists = [np.frombuffer(ids.as_buffer(), dtype="<u2") for ids in rows]
    size = np.array([len(x) for x in lists], dtype=np.int64)
    out = np.full((len(rows), 2), NO_TERM, dtype=np.int64)
    for begin, _, term, doc, times in _distinct(lists):
        own = shared[term]
        term, doc, times = term[own], doc[own], times[own]
        weight = _bm25(term, times, size[begin + doc], idf, mean)
        for column in range(2):
            starts = np.flatnonzero(np.diff(doc, prepend=-1))
            if not len(starts):
                break
            most = np.maximum.reduceat(weight, starts)
            # The first of equal weights.
            best = np.flatnonzero(weight == np.repeat(most, np.diff(np.append(starts, len(doc)))))
            best = best[np.diff(doc[best], prepend=-1) > 0]
            out[begin + doc[best], column] = term[best]
            term, doc, weight = np.delete(term, best), np.delete(doc, best), np.delete(weight, best)
    return out


def dealt(rows: DataFrame, idf: np.ndarray, mean: float, shared: np.ndarray, shard_tokens: int) -> DataFrame:
    """The rows and their shard: documents with the same heaviest term of `shared` lie together.

    Terms of few documents share a shard; one of more than a shard is split by the second heaviest term,
    and documents that agree in both by hash. The driver holds one number per term and one per shard.
    """

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _keys(batch.column(1), idf, mean, shared)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found[:, 0]), pa.array(found[:, 1])], names=["n_tokens", "a", "b"]
            )

    pairs = rows.select("n_tokens", "ids").mapInArrow(T.frugal(key), "n_tokens long, a long, b long")
    pairs = Scratch(rows.sparkSession, "packing").keep(pairs.groupBy("a", "b").agg(F.sum("n_tokens").alias("n")))
    totals = {r.a: r.n for r in pairs.groupBy("a").agg(F.sum("n").alias("n")).collect()}
    base, parts = np.zeros(NO_TERM + 1, dtype=np.int64), np.ones(NO_TERM + 1, dtype=np.int64)
    shard, held = 0, 0
    for a, n in sorted(totals.items()):
        if n > shard_tokens:
            parts[a] = -(-n // shard_tokens)
        if held and (n > shard_tokens or held + n > shard_tokens):
            shard, held = shard + 1, 0
        base[a] = shard
        held += n
        if parts[a] > 1:
            shard, held = shard + int(parts[a]), 0
    # Each cut between two parts of a term, as the second term in which it falls.
    size = F.sum("n").over(Window.partitionBy("a"))
    upto = F.sum("n").over(Window.partitionBy("a").orderBy("b"))
    count = F.ceil(F.col("size") / F.lit(shard_tokens))
    at = lambda place: F.floor(place * F.col("parts") / F.col("size")).cast("long")
    cuts = pairs.withColumn("size", size).withColumn("upto", upto).where(F.col("size") > shard_tokens)
    cuts = cuts.withColumn("parts", count).withColumn("cuts", at(F.col("upto")) - at(F.col("upto") - F.col("n")))
    ends = [(r.a, r.b) for r in cuts.where("cuts > 0").selectExpr("a", "b", "explode(sequence(1L, cuts))").collect()]
    # The last cut of a term is its end.
    ends = np.array(sorted(a << 17 | b for a, b in ends), dtype=np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _keys(batch.column(batch.schema.get_field_index("ids")), idf, mean, shared)
            a, both = found[:, 0], found[:, 0] << 17 | found[:, 1]
            begin = np.searchsorted(ends, a << 17)
            low = np.searchsorted(ends, both) - begin
            high = np.minimum(np.searchsorted(ends, both, side="right") - begin, parts[a] - 1)
            row = batch.column(batch.schema.get_field_index("row")).to_numpy(zero_copy_only=False).astype(np.uint64)
            some = (T.mix64(row, 5) % (high - low + 1).astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base[a] + low + some)], names=[*batch.schema.names, "shard"])

    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(T.frugal(deal), f"{schema}, shard long")


class Index:
    """BM25 index of one shard: postings by term, weights from corpus-wide frequencies."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        found = [(term, begin + doc, times) for begin, _, term, doc, times in _distinct(docs)]
        term, owner, times = (np.concatenate(x) for x in zip(*found))
        weight = _bm25(term, times, np.array([len(d) for d in docs])[owner], idf, mean)
        self.by_doc = np.searchsorted(owner, np.arange(len(docs) + 1))
        self.term, self.size = term, len(docs)
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = owner[order], weight[order]
        self.bounds = np.searchsorted(term[order], np.arange((1 << 16) + 1))
        self.held = len(docs)

    def _thin(self, unused: np.ndarray, left: int) -> None:
        """Takes the documents out of the postings that are used up: they are nobody's neighbours any more."""
        kept = unused[self.docs]
        self.bounds = np.concatenate([[0], np.cumsum(kept)])[self.bounds]
        self.docs, self.weights, self.held = self.docs[kept], self.weights[kept], left

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first; ties by place."""
        left = int(np.count_nonzero(unused))
        if 4 * left < 3 * self.held:
            self._thin(unused, left)
        terms = self.term[self.by_doc[seed] : self.by_doc[seed + 1]]
        low, high = self.bounds[terms], self.bounds[terms + 1]
        some = high > low
        if not some.any():
            return np.zeros(0, dtype=np.int64)
        spans = [slice(a, b) for a, b in zip(low[some].tolist(), high[some].tolist())]
        score = np.bincount(
            np.concatenate([self.docs[s] for s in spans]),
            weights=np.concatenate([self.weights[s] for s in spans]),
            minlength=self.size,
        )
        score[~unused] = 0
        found = np.flatnonzero(score > 0)
        return found[np.argsort(-score[found], kind="stable")]


def packed(shard: int, docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[tuple]:
    """(document, start, length, sequence, offset) of the pieces of one shard.

    A document fills windows of its own while it can; its rest is a seed or a neighbour. A window
    that a seed opens takes the seed's unused neighbours, best first; the one that does not fit is cut,
    and its rest opens the next window. Without neighbours the next unused document follows.
    """
    pieces, sequence = [], shard << 32
    start = np.zeros(len(docs), dtype=np.int64)
    for d, ids in enumerate(docs):
        while len(ids) - start[d] >= window:
            pieces.append((d, int(start[d]), window, sequence, 0))
            start[d] += window
            sequence += 1
    left = np.array([len(ids) for ids in docs], dtype=np.int64) - start
    unused = left > 0
    index = Index(docs, idf, mean)
    following, cut = 0, -1
    while True:
        seed = cut
        if seed < 0:
            while following < len(docs) and not unused[following]:
                following += 1
            if following == len(docs):
                return pieces
            seed = following
        cut, filled, queue = -1, 0, [seed]
        wanted, k = None, 0
        while queue or filled < window:
            if not queue:
                if wanted is None:
                    wanted, k = index.neighbours(seed, unused), 0
                while k < len(wanted) and not unused[wanted[k]]:
                    k += 1
                if k < len(wanted):
                    queue.append(int(wanted[k]))
                else:
                    while following < len(docs) and not unused[following]:
                        following += 1
                    if following == len(docs):
                        break
                    queue.append(following)
            d = queue.pop()
            n = int(min(left[d], window - filled))
            pieces.append((d, int(start[d]), n, sequence, filled))
            start[d] += n
            left[d] -= n
            filled += n
            unused[d] = left[d] > 0
            if left[d] > 0:
                cut = d
        sequence += 1


def packing(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents are dealt by their heaviest terms to shards of about SHARD_TOKENS tokens, each with a BM25 index over
    whole texts and the frequencies of the whole corpus; neighbours in other shards are not found. All sequences are full but the last of
    a shard. Null and empty texts are documents of the end id alone; repeated rows and rows without an
    id are documents of their own; an empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    rows = scratch.keep(tokens(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()))
    total = rows.agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")).first()
    n_docs, n_tokens = total.docs, total.tokens or 0
    seen = frequencies(rows)
    idf, mean = np.log1p((n_docs - seen + 0.5) / (seen + 0.5)), max(n_tokens / max(n_docs, 1), 1.0)
    kind = dict(docs.dtypes)["doc_id"]

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row", ignore_index=True)
        ids = [np.frombuffer(b, dtype="<u2") for b in frame["ids"]]
        pieces = packed(int(frame["shard"].iloc[0]), ids, idf, mean, window)
        at = [p[0] for p in pieces]
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"].iloc[at].to_numpy(),
                "start": [p[1] for p in pieces],
                "length": [p[2] for p in pieces],
                "ids_crc32": [zlib.crc32(ids[d][s : s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces],
                "doc_tokens": [len(ids[d]) for d in at],
                "sequence_id": [p[3] for p in pieces],
                "offset": [p[4] for p in pieces],
            }
        )

    # A term that would not fill a good part of a shard leaves its documents among strangers.
    shared = seen >= max(2, SHARD_TOKENS / (4 * mean))
    placed = dealt(rows, idf, mean, shared, SHARD_TOKENS)
    return (
        placed.groupBy("shard")
        .applyInPandas(
            pack,
            f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
        )
    )
