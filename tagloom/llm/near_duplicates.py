"""Near-duplicate documents by min-max hashing (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textcols as T
from tagloom.llm.lsh import similar_components
from tagloom.llm.narrow import fresh, possible, residues
from tagloom.llm.scratch import Scratch

#: 30 bands of 5 values miss a pair of similarity 0.8 less than once in 100,000 times.
#: Half the values are minima, half maxima: 75 permutations make 150 values.
BANDS, ROWS = 30, 5


def _shingled(part: T.Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    found = T.words(part)
    return T.shingles(found, T.byte_hashes(T.lower_ascii(part.data), found.starts, found.ends), k)


def sketches(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, digest of the set (d1, d2), band keys; one row per document."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for part in T.slices(batch.column(1)):
                n = len(part)
                row, value = _shingled(part, k)
                signature = T.min_max_signatures(n, row, value, bands * rows // 2)
                keys = T.band_keys(signature, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(part.first, n),
                        pa.array(T.sums_by_row(n, row)),
                        pa.array(T.sums_by_row(n, row, T.mix64(value, 1)).view(np.int64)),
                        pa.array(T.sums_by_row(n, row, T.mix64(value, 2)).view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)), pa.array(keys.ravel())
                        ),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        T.frugal(sketch), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"
    )


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """id, members: the full shingle set of each document as distinct 64-bit hashes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(1)):
                n = len(part)
                row, value = _shingled(part, k)
                bounds = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                members = pa.ListArray.from_arrays(pa.array(bounds), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, n), members], names=["id", "members"]
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        T.frugal(sets), "id long, members array<long>"
    )


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of `docs`.

    Documents are linked where 100 * intersection >= percent * union of their sets of
    `shingle_words`-word shingles (ASCII lower case; fewer words: the whole sequence is the one
    shingle). component_id is the least doc_id that links reach; kept marks that document.

    Null, empty and wordless texts have no shingles and no links. Rows that share a
    doc_id are one node of the graph. Rows without a doc_id are not linked, have no
    component_id and are kept. Other columns of `docs` are not read. Texts of any length
    are worked on whole. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    own = scratch.keep(sketches(docs, shingle_words))
    linkable = own.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Copies with the same set enter as one: their least id.
    same = scratch.keep(
        linkable.groupBy("n_shingles", "d1", "d2").agg(
            F.min("doc_id").alias("id"), F.count("*").alias("copies"), F.any_value("bands").alias("bands")
        )
    )

    def fetch(ids: DataFrame) -> DataFrame:
        wanted = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
        near = possible(wanted.select(F.col("doc_id").cast("long"), "text"), residues(ids, "id"), "doc_id")
        return shingle_sets(near.join(ids, F.col("doc_id") == F.col("id"), "left_semi"), shingle_words)

    found, _ = similar_components(same.select("id", "bands"), fetch, percent, scratch)
    labels = (
        same.select("n_shingles", "d1", "d2", "id")
        .join(found.withColumnRenamed("node", "id"), "id", "left")
        .select("n_shingles", "d1", "d2", F.coalesce("component", "id").alias("component"))
    )
    named = linkable.select("doc_id", "n_shingles", "d1", "d2").join(labels, ["n_shingles", "d1", "d2"])
    alone = own.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component")
    )
    return (
        named.select("doc_id", "n_shingles", "component")
        .unionByName(alone)
        .select(
            "doc_id",
            "n_shingles",
            F.col("component").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
        )
    )


def keep_one_of_each_group(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps, with all their columns.

    Of rows that share a kept doc_id the least stays, compared column by column, text first; rows without a
    doc_id all stay. Only ids are counted for that: rows whose id occurs once are not moved.
    """
    scratch = Scratch(docs.sparkSession, "dropped")
    names, key = docs.columns, fresh(docs, "_doc")
    dropped = near_duplicates(docs, shingle_words, percent).where("NOT kept").select(F.col("doc_id").alias(key)).distinct()
    dropped = scratch.keep(dropped)
    ids = docs.select(F.col("doc_id").cast("long").alias(key)).where(F.col(key).isNotNull())
    repeated = scratch.keep(ids.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key))
    keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    touched = residues(dropped.unionByName(repeated), key)
    left = possible(keyed, touched, key).join(dropped, key, "left_anti")
    one = F.min(F.struct("text", *[c for c in names if c != "text"])).alias("row")
    copies = left.join(repeated, key, "left_semi").groupBy(key).agg(one).select("row.*").select(*names)
    single = left.join(repeated, key, "left_anti").select(*names)
    untouched = possible(keyed, touched, key, within=False).select(*names)
    return untouched.unionByName(single).unionByName(copies)
