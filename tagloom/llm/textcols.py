"""Whole columns of text as numpy arrays: slices of a batch, words, hashes.

A task reads an Arrow batch, cuts it into slices of bounded size and works on each
slice at once. No text is ever cut: a text longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; only memory and speed depend on it.
SLICE_BYTES = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POLY = np.uint64(0xD6E8FEB86659FD93)
_POLY_INVERSE = np.uint64(pow(int(_POLY), -1, 1 << 64))


def frugal(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`task`, after whose last batch unused memory goes back to the system: a worker lives on for many tasks, and what
    each of them leaves free but held adds up beside the executor's heap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()

    return run


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = x + np.uint64((seed * int(_ODD) + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _byte_values() -> np.ndarray:
    return mix64(np.arange(256, dtype=np.uint64), 77)


_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next slice."""
    table = _powers.get(int(base))
    if table is None or len(table) < n:
        table = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        np.cumprod(table, out=table)
        if len(table) <= 4 * SLICE_BYTES:
            _powers[int(base)] = table
    return table[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[s:e] for every span; equal spans have equal hashes."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _power_table(_POLY, n), out=sums[1:])
    shift = _power_table(_POLY_INVERSE, n + 1)[starts]
    return mix64((sums[ends] - sums[starts]) * shift + (ends - starts).astype(np.uint64))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans."""
    return span_hashes(_byte_values()[data], starts, ends)


@dataclass
class Slice:
    """Rows first .. last of a batch; `offsets` has one more entry than there are rows."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.last - self.first

    def text(self, row: int) -> str:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes().decode()


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices of a text column of at most `size` bytes, one row at least; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield Slice(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@cache
def _separators() -> np.ndarray:
    """True for the ASCII white space that parts words: space and 0x09 to 0x0D."""
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


@cache
def _lowered() -> np.ndarray:
    """Bytes with A-Z as a-z; UTF-8 keeps every other character as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _lowered()[data]


def code_point_starts(data: np.ndarray) -> np.ndarray:
    """True where a UTF-8 character begins."""
    return (data & 0xC0) != 0x80


@dataclass
class Words:
    """Words of a slice in order; `bounds[r] .. bounds[r + 1]` are those of row r."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(part: Slice) -> Words:
    """Maximal runs without ASCII white space, never across rows."""
    inside = np.zeros(len(part.data) + 1, dtype=np.int8)
    inside[:-1] = ~_separators()[part.data]
    step = np.diff(inside, prepend=np.int8(0))
    cuts = part.offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(part.data))])
    glued = cuts[(inside[cuts] == 1) & (inside[cuts - 1] == 1)]
    starts = np.flatnonzero(step == 1)
    ends = np.flatnonzero(step == -1)
    if len(glued):  # a word at the end of a row and one at the start of the next
        starts = np.sort(np.concatenate([starts, glued]))
        ends = np.sort(np.concatenate([ends, glued]))
    return Words(starts, ends, np.searchsorted(starts, part.offsets))


def window_hashes(found: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every k-word window inside one row."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    total = np.zeros(n - k + 1, dtype=np.uint64)
    for j in range(k):
        total = total * _ODD + hashes[j : n - k + 1 + j]
    rows = found.rows
    first = np.flatnonzero(rows[: n - k + 1] == rows[k - 1 :])
    return first, mix64(total[first], k)


def shingles(found: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct k-word shingles of each row, sorted by row and hash.

    A row with some words but fewer than k has one shingle, its whole sequence; a row
    without words has none.
    """
    first, values = window_hashes(found, hashes, k)
    rows = found.rows[first]
    for r in np.flatnonzero((found.counts > 0) & (found.counts < k)):
        own = hashes[found.bounds[r] : found.bounds[r + 1]]
        total = np.zeros(1, dtype=np.uint64)
        for h in own:
            total = total * _ODD + h
        rows = np.append(rows, r)
        values = np.append(values, mix64(total, 1000 + len(own)))
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    if len(rows):
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
        rows, values = rows[new], values[new]
    return rows, values


def sums_by_row(n: int, rows: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """Sum of `values` (or the count) of each of n rows."""
    if values is None:
        return np.bincount(rows, minlength=n).astype(np.int64)
    out = np.zeros(n + 1, dtype=values.dtype)
    sums = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=sums[1:])
    bounds = np.searchsorted(rows, np.arange(n + 1))
    out = sums[bounds]
    return out[1:] - out[:-1]


def min_max_signatures(n: int, rows: np.ndarray, hashes: np.ndarray, permutations: int) -> np.ndarray:
    """Min-max signatures of n sets: the minima, then the maxima, of every permutation.

    `rows` is sorted. Each permutation is evaluated once and yields two values. A set
    without members has zeros.
    """
    out = np.zeros((2 * permutations, n), dtype=np.uint32)
    if not len(rows):
        return out.T
    small = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    present = rows[starts]
    spare = mix64(np.arange(2 * permutations, dtype=np.uint64), 4242).astype(np.uint32)
    # Blocks of whole sets: large enough that the calls cost little, small enough for the processor's cache.
    block, size = 0, 1 << 17
    while block < len(present):
        stop = int(np.searchsorted(starts, starts[block] + size, side="right")) - 1
        stop = len(present) if starts[-1] < starts[block] + size else max(stop, block + 1)
        lo = starts[block]
        hi = starts[stop] if stop < len(present) else len(small)
        own, at = small[lo:hi], starts[block:stop] - lo
        turned = np.empty_like(own)
        for p in range(permutations):
            np.bitwise_xor(own, spare[p], out=turned)
            np.multiply(turned, spare[permutations + p] | np.uint32(1), out=turned)
            out[p, present[block:stop]] = np.minimum.reduceat(turned, at)
            out[permutations + p, present[block:stop]] = np.maximum.reduceat(turned, at)
        block = stop
    return out.T


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band; bands never share keys."""
    n = len(signatures)
    keys = np.empty((n, bands), dtype=np.uint64)
    for b in range(bands):
        total = np.full(n, b, dtype=np.uint64)
        for j in range(b * rows, (b + 1) * rows):
            total = total * _ODD + signatures[:, j]
        keys[:, b] = mix64(total)
    return keys.view(np.int64)
