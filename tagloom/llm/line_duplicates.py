"""Similar lines of a corpus, one kept of each component (operator 10)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textcols as T
from tagloom.llm.lsh import PARITY_TYPE, Reading, parities, similar_components
from tagloom.llm.narrow import fresh, possible, residues
from tagloom.llm.scratch import Scratch

#: Characters of a shingle; unless told otherwise, lines of LEAST characters or more take part: all that are not blank.
SHINGLE, LEAST = 8, 1
#: 14 bands of 4 values (28 permutations) miss a pair of similarity 0.8 in fewer than 1 of 1,000 cases.
BANDS, ROWS, PERCENT = 14, 4, 80
#: The white space around a line that is not compared.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def _lines(part: T.Slice, least: int) -> dict:
    """Lines of a slice with `least` characters that are not blank: row, line (its number in the text), digest, and their
    code points one after the other, from `bounds` to `bounds`.

    A line is compared without the white space around it and with ASCII letters in lower case.
    """
    row, line, sizes, contents = [], [], [], []
    for r in range(len(part)):
        for i, x in enumerate(part.text(r).split("\n")):
            x = x.strip(BLANKS)
            if x and len(x) >= least:
                row.append(r)
                line.append(i)
                sizes.append(len(x))
                contents.append(x.encode().lower())  # ASCII letters alone
    digest = np.frombuffer(b"".join([hashlib.blake2b(x, digest_size=16).digest() for x in contents]), dtype="<u8").reshape(-1, 2)
    return {
        "points": np.frombuffer(b"".join(contents).decode().encode("utf-32-le"), dtype=np.uint32).astype(np.uint64),
        "row": np.array(row, dtype=np.int64),
        "line": np.array(line, dtype=np.int32),
        "bounds": np.cumsum([0, *sizes]),
        "h1": digest[:, 0].copy(),
        "h2": digest[:, 1].copy(),
    }


def _line(rows: list[str], line: int, h1: int) -> str | None:
    """A line of a text split at its breaks as `_lines` cuts it; None unless its digest begins with `h1`."""
    if line >= len(rows):
        return None
    content = rows[line].strip(BLANKS).encode().lower()  # ASCII letters alone
    same = hashlib.blake2b(content, digest_size=16).digest()[:8] == h1.to_bytes(8, "little", signed=True)
    return content.decode() if same else None


def _windows(points: np.ndarray) -> np.ndarray:
    """One polynomial value for each run of SHINGLE (a power of two) code points, by doubling."""
    total, factor, width = points, 0x9E3779B97F4A7C15, 1
    while width < SHINGLE:
        front = total[:-width] * np.uint64(factor)
        front += total[width:]
        total, factor, width = front, factor * factor % (1 << 64), 2 * width
    return total


def _set(line: str) -> np.ndarray:
    """The distinct shingles of a line as `_lines` cuts it."""
    every = np.sort(_windows(np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)))
    return every[np.concatenate([np.ones(min(len(every), 1), dtype=bool), every[1:] != every[:-1]])]


def _shingles(found: dict, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the line, hash) of all character shingles of the lines `wanted` (marked), repeats included."""
    bounds = found["bounds"]
    size = np.where(wanted, np.maximum(np.diff(bounds) - SHINGLE + 1, 0), 0)
    if not size.any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    total = _windows(found["points"])
    # From each line's first window to its last; what lies between belongs to two lines or to none that is wanted.
    edges = np.stack([size, np.diff(np.minimum(bounds, len(total))) - size], axis=1)
    inside = np.repeat(np.tile([True, False], len(size)), edges.ravel())
    return np.repeat(np.arange(len(size)), size), T.mix64(total[inside], 9)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def line_sketches(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, line, h1, h2 (digest of the content), bands: one row per line that takes part.

    Lines without a whole shingle have no bands: they are like their exact copies alone. Of equal lines of a batch the
    first alone has them.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for part in T.slices(batch.column(1)):
                found = _lines(part, least)
                n = len(found["row"])
                some = np.diff(found["bounds"]) >= SHINGLE
                for i, h in enumerate(found["h1"].tolist()):
                    some[i] &= h not in seen
                    seen.add(h)
                owner, hashes = _shingles(found, some)
                keys = T.band_keys(T.min_max_signatures(n, owner, hashes, BANDS * ROWS // 2), BANDS, ROWS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)).take(pa.array(found["row"])),
                        pa.array(found["line"]),
                        _signed(found["h1"]),
                        _signed(found["h2"]),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(some) * BANDS]).astype(np.int32)), pa.array(keys[some].ravel())
                        ),
                    ],
                    names=["doc_id", "line", "h1", "h2", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        T.frugal(sketch), "doc_id long, line int, h1 long, h2 long, bands array<long>"
    )


def _line_texts(docs: DataFrame) -> DataFrame:
    """id, n, members, bits: the lines that the column `wanted` (line, h1) of each document names, as text, with the
    number and the parities of their shingles."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines: dict[int, str] = {}
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = (text or "").split("\n")
                for w in wanted:
                    if w["h1"] not in lines and (content := _line(rows, w["line"], w["h1"])) is not None:
                        lines[w["h1"]] = content
            sets = [_set(x) for x in lines.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(lines), pa.int64()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(list(lines.values()), pa.string()),
                    parities([T.mix64(x, 9) for x in sets]),
                ],
                names=["id", "n", "members", "bits"],
            )

    return docs.select(F.col("text").cast("string"), "wanted").mapInArrow(
        T.frugal(texts), f"id long, n long, members string, bits {PARITY_TYPE}"
    )


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """The size of the intersection of two sets."""
    both = np.concatenate([x, y])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _common(pairs: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[int, np.ndarray] = {}  # the set of a line is built once a batch
            ends = [batch.column(c).to_pylist() for c in ("a", "b")]
            for end, text in zip(ends, ("x", "y")):
                where = {line: i for i, line in enumerate(end) if line not in sets}
                texts = batch.column(text).take(pa.array(where.values(), pa.int64())).to_pylist()
                sets.update((line, _set(x)) for line, x in zip(where, texts))
            common = [_shared(sets[a], sets[b]) for a, b in zip(*ends)]
            kept = ["a", "b", "n_a", "n_b"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(common, pa.int64())], names=[*kept, "common"])

    schema = "a long, b long, n_a long, n_b long, common long"
    return pairs.select("a", "b", "n_a", "n_b", "x", "y").mapInArrow(T.frugal(count), schema)


def _each(lines: DataFrame) -> DataFrame:
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, line in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = _set(line.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), i, dtype=np.int64)), _signed(own)], names=["id", "member"]
                )

    return lines.select("id", "members").mapInArrow(spread, "id long, member long")


#: Sets kept as the text of the line, a small part of the size of its hashed shingles.
TEXTS = Reading(common=_common, each=_each)


def repeated_lines(docs: DataFrame, scratch: Scratch, least: int = LEAST) -> DataFrame:
    """doc_id, drop (line, h1): the lines of each document that are not the first of their component.

    h1, a digest of 64 bits, names a line while links are searched; equal lines agree in h2 as well.
    """
    known = docs.where("doc_id IS NOT NULL")
    lines = scratch.keep(line_sketches(known, least))
    place = F.struct("doc_id", "line")
    firsts = scratch.keep(lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("copies")))

    def fetch(ids: DataFrame) -> DataFrame:
        near = possible(firsts.select("first", "h1"), residues(ids, "id"), "h1").join(ids, F.col("h1") == F.col("id"), "left_semi")
        near = near.groupBy("h1").agg(F.min("first").alias("first"))
        line = F.struct(F.col("first.line").alias("line"), "h1")
        wanted = near.groupBy(F.col("first.doc_id").alias("doc")).agg(F.collect_list(line).alias("wanted"))
        wanted = scratch.keep(wanted)
        texts = known.select(F.col("doc_id").cast("long").alias("doc"), "text")
        found = possible(texts, residues(wanted, "doc"), "doc").join(wanted, "doc")
        return _line_texts(found).dropDuplicates(["id"])

    found, _ = similar_components(lines.select(F.col("h1").alias("id"), "bands"), fetch, PERCENT, scratch, TEXTS)
    linked = possible(firsts.where("copies = 1"), residues(found, "node"), "h1")
    groups = (
        firsts.where("copies > 1")
        .unionByName(linked)
        .join(found.withColumnRenamed("node", "h1"), "h1", "left")
        .where("copies > 1 OR component IS NOT NULL")
        # Unlinked lines are told apart by the whole digest.
        .withColumn("apart", F.when(F.col("component").isNull(), F.col("h2")).otherwise(F.lit(0)))
        .select("h1", "h2", "first", "apart", F.coalesce("component", "h1").alias("component"))
    )
    groups = scratch.keep(groups)
    keepers = groups.groupBy("component", "apart").agg(F.min("first").alias("keeper"))
    decided = scratch.keep(groups.join(keepers, ["component", "apart"]).select("h1", "h2", "keeper"))
    occurrences = possible(lines.drop("bands"), residues(decided, "h1"), "h1")
    dropped = occurrences.join(decided, ["h1", "h2"]).where(F.struct("doc_id", "line") != F.col("keeper"))
    return scratch.keep(dropped.groupBy("doc_id").agg(F.collect_set(F.struct("line", "h1")).alias("drop")))


def without_repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows and columns of `docs`, and _removed and _left: lines taken out, words left.

    Lines of `least` characters or more (1: all) are similar where the Jaccard index of their sets of
    8-character shingles is 0.8 or more; of each component of similar lines the first (least doc_id,
    then line number) stays, everywhere else they are taken out with their line break.
    Lines of under 8 characters are similar to exact copies only. Shorter lines than `least` and blank ones stay. n_chars, where there is such a column, follows the new text.

    Rows without a doc_id or text stay as they are. Rows that share a doc_id are copies of one document: each
    keeps that document's first lines. Columns of `docs` called _removed and _left are replaced. An empty
    table gives no rows.
    """
    docs = docs.drop("_removed", "_left")
    key, drop = fresh(docs, "_doc"), fresh(docs, "_drop")
    scratch = Scratch(docs.sparkSession, "lines")
    dropped = repeated_lines(docs.select("doc_id", "text"), scratch, least)
    dropped = dropped.select(F.col("doc_id").alias(key), F.col("drop").alias(drop))
    gone = residues(dropped, key)
    keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    names = docs.columns
    left = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    untouched = possible(keyed, gone, key, within=False).select(*names, F.lit(0).alias("_removed"), left.alias("_left"))
    touched = possible(keyed, gone, key).join(dropped, key, "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            out, removed = batch.column(at).to_pylist(), [0] * len(batch)
            for i, marked in enumerate(batch.column(len(names)).to_pylist()):
                if not marked or not out[i]:
                    continue
                rows = out[i].split("\n")
                out_of = {d["line"] for d in marked if _line(rows, d["line"], d["h1"]) is not None}
                out[i] = "\n".join(x for k, x in enumerate(rows) if k not in out_of)
                removed[i] = len(out_of)
            columns = [pa.array(out, batch.schema.field(at).type) if k == at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int32())], names=[*names, "_removed"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + ", _removed int"
    cut_rows = touched.select(*names, drop).mapInArrow(T.frugal(cut), schema).withColumn("_left", left)
    both = untouched.unionByName(cut_rows)
    if "n_chars" in names:
        length = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        both = both.withColumn("n_chars", F.when(F.col("_removed") > 0, length).otherwise(F.col("n_chars")))
    return both
