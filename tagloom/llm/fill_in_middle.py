"""Fill-in-middle by secondary sort (operator 13).

Every text is cut into pieces of some units each. A piece is keyed by its document and by its place
in the output; `repartition_and_sort_within_partitions` brings the pieces of a document to one task in
the order of the output, where they stream into a digest or a text. Sorted again by their place in
the original, without another shuffle, the same pieces give the restored text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.textcols import slices, words

#: Fixed values of the format.
SEED = 42
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SPLIT_PERCENT, SPM_PERCENT = 50, 80
_SENTINEL = re.compile(rb"<[PSM]>")
#: Place of a section in the original text.
_RANK = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_ORDER = {"spm": (SUFFIX, PREFIX, MIDDLE), "psm": (PREFIX, SUFFIX, MIDDLE)}

#: Units of one piece, and bytes at which a piece of long units is cut. Only memory depends on them.
PIECE_UNITS, PIECE_BYTES = 512, 1 << 13
#: Rows and bytes of one batch that a task hands on.
BATCH_ROWS, BATCH_BYTES = 4096, 1 << 22

_KEY = [("key", pa.binary()), ("rank", pa.int32()), ("place", pa.int32()), ("piece", pa.binary())]
_HEAD = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string())]
_FOUND = [*_HEAD, ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_PIECES = pa.schema([*_KEY, *_HEAD])
_SECTIONS = pa.schema([*_KEY, ("copies", pa.int64()), *_FOUND, ("output_sha256", pa.string())])
_RESULT = pa.schema([*_FOUND, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_TEXTS = pa.schema([*_FOUND, ("output", pa.large_string())])


def _draws(doc_id: int | None) -> list[int]:
    """The four numbers a document id yields; a missing id is an empty text."""
    text = f"{SEED}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(text.encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _sections(text: bytes, ends: np.ndarray, doc_id: int | None):
    """(number of units, form, [(sentinel, first unit, last unit)]) of one text; `ends` are those of its units."""
    n = len(ends)
    h1, h2, h3, h4 = _draws(doc_id)
    if not text or h3 % 100 >= SPLIT_PERCENT or _SENTINEL.search(text):
        return n, "plain", [(b"", 0, n)]
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
    units = {PREFIX: (0, first), MIDDLE: (first, second), SUFFIX: (second, n)}
    return n, form, [(s, *units[s]) for s in _ORDER[form]]


def _chunks(text: bytes, ends: np.ndarray, first: int, last: int) -> Iterator[bytes]:
    """Units first .. last in pieces of PIECE_UNITS units, long ones cut at PIECE_BYTES."""
    for unit in range(first, last, PIECE_UNITS):
        start = int(ends[unit - 1]) if unit else 0
        end = int(ends[min(unit + PIECE_UNITS, last) - 1])
        for at in range(start, end, PIECE_BYTES):
            yield text[at : min(at + PIECE_BYTES, end)]


def _pieces_of_slice(ids: list, part, home: int) -> Iterator[tuple]:
    found = words(part)
    data = part.data.tobytes()
    for row, doc_id in enumerate(ids):
        lo, hi = int(part.offsets[row]), int(part.offsets[row + 1])
        text = data[lo:hi]
        ends = found.ends[found.bounds[row] : found.bounds[row + 1]] - lo
        if len(text) and (not len(ends) or ends[-1] < len(text)):
            ends = np.append(ends, len(text))  # white space after the last word is a unit
        n, form, sections = _sections(text, ends, doc_id)
        # Equal rows of one task share a key; their pieces are equal too, and are counted.
        key = hashlib.blake2b(text, digest_size=16, key=f"{home}:{doc_id}".encode()).digest()
        yield key, 0, 0, b"", doc_id, n, form
        place = 1
        for sentinel, first, last in sections:
            if sentinel:
                yield key, 0, place, sentinel, None, None, None
                place += 1
            for chunk in _chunks(text, ends, first, last):
                yield key, 0, place, chunk, None, None, None
                place += 1


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(document, 0, place in the output, piece) of every row; place 0 also has id, units and form."""
    home = TaskContext.get().partitionId()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for part in slices(batch.column(1)):
            yield from _pieces_of_slice(ids[part.first : part.last], part, home)


def _mapped(df: DataFrame, fn: Callable, schema: pa.Schema) -> DataFrame:
    """`df` through `fn`, which takes and gives rows; `schema` is that of the rows it gives."""

    def batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    names = ", ".join(f"{f.name} {kinds.get(f.type, 'string')}" for f in schema)
    return df.mapInArrow(lambda given: batches(fn(given)), names)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def repartition_and_sort_within_partitions(df: DataFrame) -> DataFrame:
    """The pieces of a document in one partition, in order: one shuffle, and a sort that spills to disk.

    Every byte is moved once. How many partitions there are is for the session to say.
    """
    return df.repartition("key").sortWithinPartitions("key", "rank", "place")


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(document, how many equal rows, (id, units, form), its pieces in order) of sorted pieces.

    The pieces must be read before the next document is.
    """

    def distinct(rest, copies):
        last = 0
        for _, _, place, piece, *_ in rest:
            if place == 0:
                copies[0] += 1
            elif place != last:
                last = place
                yield piece

    for key, own in groupby(_rows(batches), key=lambda row: row[0]):
        head = next(own)
        copies = [1]
        yield key, copies, head[4:], distinct(own, copies)


def _parsed(form: str, output: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """(place in the original, bytes) of the sections of a streamed output, told apart by its sentinels."""
    if form == "plain":
        for chunk in output:
            yield 0, chunk
        return
    rank, rest = -1, b""
    for chunk in output:
        rest += chunk
        at = 0
        for found in _SENTINEL.finditer(rest):
            if found.start() > at:
                yield rank, rest[at : found.start()]
            rank, at = _RANK[found.group()], found.end()
        # A sentinel may begin in the last two bytes.
        keep = max(at, len(rest) - 2)
        if keep > at:
            yield rank, rest[at:keep]
        rest = rest[keep:]
    if rest:
        yield rank, rest


def _code_points(chunk: bytes) -> int:
    return int(((np.frombuffer(chunk, dtype=np.uint8) & 0xC0) != 0x80).sum())


def _streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Digests of the outputs, and the sections of the outputs keyed by their place in the original."""
    for key, copies, (doc_id, n, form), output in _documents(batches):
        digest = hashlib.sha256()
        chars = [0, 0, 0]

        def read(output=output, digest=digest):
            for piece in output:
                digest.update(piece)
                yield piece

        for place, (rank, chunk) in enumerate(_parsed(form, read())):
            chars[rank] += _code_points(chunk)
            yield key, rank, place, chunk, *[None] * 7
        sizes = (None, None) if form == "plain" else (chars[0], chars[1])
        yield key, -1, 0, b"", copies[0], doc_id, n, form, *sizes, digest.hexdigest()


def _restored(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """One row per document: what `_streamed` found, and the digest of the text put back in order."""
    for _, own in groupby(_rows(batches), key=lambda row: row[0]):
        copies, *found = next(own)[4:]
        digest = hashlib.sha256()
        for _, _, _, chunk, *_ in own:
            digest.update(chunk)
        for _ in range(copies):
            yield *found, digest.hexdigest()


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for _, copies, (doc_id, n, form), output in _documents(batches):
        chunks = list(output)
        chars = [0, 0, 0]
        for rank, chunk in _parsed(form, chunks):
            chars[rank] += _code_points(chunk)
        sizes = (None, None) if form == "plain" else (chars[0], chars[1])
        for _ in range(copies[0]):
            yield doc_id, n, form, *sizes, b"".join(chunks).decode()


def _sorted_pieces(docs: DataFrame) -> DataFrame:
    """The pieces of all documents, sorted by document and place in the output."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return repartition_and_sort_within_partitions(_mapped(rows, _pieces, _PIECES))


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output: one row per row of `docs`.

    Half of the texts, chosen by the id, are cut at two places between units and put together again
    around sentinels; empty texts and those that hold a sentinel stay as they are (form plain, the two
    sizes null). Null texts are empty, a null id counts as an empty id, repeated rows are repeated,
    an empty table gives no rows, and columns other than doc_id and text are not looked at.
    """
    return _mapped(_sorted_pieces(docs), _texts, _TEXTS)


def fill_in_middle_digests(docs: DataFrame) -> DataFrame:
    """As `fill_in_middle`, with the digests of the output and of the text restored from it.

    No text is put together: both are read piece by piece. The restored text comes from the streamed
    output alone, whose sections are keyed by their place in the original and sorted again. The pieces of
    a document are in one partition already, so nothing is shuffled for it.
    """
    sections = _mapped(_sorted_pieces(docs), _streamed, _SECTIONS)
    return _mapped(sections.sortWithinPartitions("key", "rank", "place"), _restored, _RESULT)
