"""Periodic runs of words found on a Re-Pair grammar (operator 11).

The words of a text become numbers, and Re-Pair replaces pairs of neighbours that occur more than once
by nonterminals. What is left of the text is halved again and again, so that everything is a binary
tree. A run of words lies across the boundary of some nonterminal whose two halves hold it whole: each
nonterminal's boundary is looked at once, in one of its places, and what is found there is moved to all
places of the nonterminal. Runs that were cut off at the edge of a nonterminal are swallowed by merging.

A slice of many texts is worked on at once, with arrays; no pair reaches across two texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.textcols import Slice, Words, mix64, slices, words

#: A run has at least LEAST_WORDS words, and LEAST_TIMES times its period.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Candidate periods looked at in one step; only memory depends on it.
STEP = 1 << 20
#: Two primes below 2**31, so that products of residues fit in 64 bits.
_PRIMES = (np.uint64(2147483647), np.uint64(2147483629))

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", _RUN), ("collapsed", pa.large_string())])


def word_numbers(part: Slice, found: Words) -> tuple[np.ndarray, pa.Array]:
    """The number of each word, equal for equal words, and the words by number."""
    lengths = found.ends - found.starts
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(found.starts - offsets[:-1], lengths)
    packed = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(part.data[at].tobytes())]
    )
    coded = packed.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. c-1 for every count c, one after the other."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


class Equality:
    """Whether two stretches of `values` are equal, by residues of a polynomial modulo two primes."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.tables = []
        for i, prime in enumerate(_PRIMES):
            base = mix64(np.array([97 + i], dtype=np.uint64))[0] % (prime - np.uint64(2)) + np.uint64(2)
            powers = np.ones(n + 1, dtype=np.uint64)
            done, step = 1, base
            while done <= n:  # doubling: the first powers times the next one
                more = min(done, n + 1 - done)
                powers[done : done + more] = powers[:more] * step % prime
                step = step * step % prime
                done += more
            sums = np.zeros(n + 1, dtype=np.uint64)
            terms = (mix64(values.astype(np.uint64), 500 + i) % prime) * powers[:n] % prime
            np.cumsum(terms, out=sums[1:])
            self.tables.append((prime, powers, sums % prime))

    def __call__(self, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """values[a:a+l] == values[b:b+l] for every triple with a <= b."""
        same = np.ones(len(a), dtype=bool)
        for prime, powers, sums in self.tables:
            x = (sums[a + lengths] + prime - sums[a]) % prime
            y = (sums[b + lengths] + prime - sums[b]) % prime
            same &= x * powers[b - a] % prime == y
        return same

    def forward(self, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
        """How far values from a and from b on agree, `room` at most."""
        return self._longest(room, lambda n: self(a, b, n))

    def backward(self, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
        """How far values before a and before b agree, `room` at most."""
        return self._longest(room, lambda n: self(a - n, b - n, n))

    @staticmethod
    def _longest(room, agree):
        low, high = np.zeros_like(room), room.copy()
        while np.any(low < high):
            middle = (low + high + 1) >> 1
            good = agree(middle)
            low = np.where(good, middle, low)
            high = np.where(good, high, middle - 1)
        return low


class Grammar:
    """Nonterminals of a slice: boundaries, one place of each, and all places.

    first, middle, last: where one occurrence of each nonterminal begins, is parted and ends.
    owner, place: every occurrence as (nonterminal, start), sorted by nonterminal.
    """

    def __init__(self, numbers: np.ndarray, rows: np.ndarray):
        self._places: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        symbols, starts, lengths, rows = self._repair(numbers, rows)
        self._halve(starts, lengths, rows)
        parts = list(zip(*self._places)) or [(np.zeros(0, dtype=np.int64),)] * 4
        pair, start, middle, end = (np.concatenate(p) for p in parts)
        order = np.argsort(pair, kind="stable")
        pair, start, middle, end = pair[order], start[order], middle[order], end[order]
        new = np.ones(len(pair), dtype=bool)
        new[1:] = pair[1:] != pair[:-1]
        self.first, self.middle, self.last = start[new], middle[new], end[new]
        self.owner, self.place = np.cumsum(new) - 1, start

    def _repair(self, numbers, rows):
        """Pairs that occur twice or more become nonterminals, the more frequent ones first.

        In one round every occurrence is replaced whose pair is more frequent than the pairs it overlaps;
        a pair that comes up again in a later round takes the nonterminal it has. Symbols are numbered
        anew for every text, so a pair is counted within its text.
        """
        n = len(numbers)
        if n:
            _, symbols = np.unique(rows * (int(numbers.max()) + 1) + numbers, return_inverse=True)
        else:
            symbols = numbers
        next_symbol = int(symbols.max()) + 1 if n else 0
        width = 2 * n + 1  # there are never more symbols than that
        starts, lengths = np.arange(n), np.ones(n, dtype=np.int64)
        live = np.ones(max(n - 1, 0), dtype=bool)
        live &= rows[1:] == rows[:-1]
        known_pairs, known_symbols = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        while True:
            at = np.flatnonzero(live)
            pairs = symbols[at] * width + symbols[at + 1]
            distinct, which, counts = np.unique(pairs, return_inverse=True, return_counts=True)
            seen = np.searchsorted(known_pairs, distinct)
            known = np.zeros(len(distinct), dtype=bool)
            inside = seen < len(known_pairs)
            known[inside] = known_pairs[seen[inside]] == distinct[inside]
            good = (counts > 1) | known
            live[at[~good[which]]] = False
            at, which = at[good[which]], which[good[which]]
            if not len(at):
                return symbols, starts, lengths, rows
            # Equal pairs that overlap (a a a) are taken from the left: every other one of a stretch.
            rank = np.full(len(live) + 2, -1, dtype=np.int64)
            order = np.lexsort((mix64(distinct.astype(np.uint64)), counts))
            placed = np.empty(len(distinct), dtype=np.int64)
            placed[order] = np.arange(len(distinct))
            rank[at + 1] = placed[which]
            own, before, after = rank[at + 1], rank[at], rank[at + 2]
            best = (own >= before) & (own >= after)
            at, which, own, before = at[best], which[best], own[best], before[best]
            head = np.ones(len(at), dtype=bool)
            head[1:] = (at[1:] != at[:-1] + 1) | (own[1:] != own[:-1])
            stretch = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            odd = (np.arange(len(at)) - stretch) % 2 == 0
            at, which = at[odd], which[odd]
            used = np.unique(which)
            fresh = used[~known[used]]
            names = np.full(len(distinct), -1, dtype=np.int64)
            names[known] = known_symbols[seen[known]]
            names[fresh] = next_symbol + np.arange(len(fresh))
            next_symbol += len(fresh)
            known_pairs = np.concatenate([known_pairs, distinct[fresh]])
            known_symbols = np.concatenate([known_symbols, names[fresh]])
            sort = np.argsort(known_pairs)
            known_pairs, known_symbols = known_pairs[sort], known_symbols[sort]
            self._add(names[which], starts[at], lengths[at], lengths[at + 1])
            symbols[at] = names[which]
            lengths[at] += lengths[at + 1]
            changed = np.zeros(len(symbols), dtype=bool)
            changed[at] = True
            kept = np.ones(len(symbols), dtype=bool)
            kept[at + 1] = False
            old = np.append(live, False)
            old[at] = old[at + 1]  # the pair with what follows
            symbols, starts, lengths, rows = symbols[kept], starts[kept], lengths[kept], rows[kept]
            changed, old = changed[kept], old[kept]
            live = (old[:-1] | changed[:-1] | changed[1:]) & (rows[1:] == rows[:-1])

    def _halve(self, starts, lengths, rows):
        """Neighbours are joined two by two, level by level, until each text is one tree."""
        name = -1
        while len(rows) > 1:
            head = np.ones(len(rows), dtype=bool)
            head[1:] = rows[1:] != rows[:-1]
            index = np.arange(len(rows)) - np.maximum.accumulate(np.where(head, np.arange(len(rows)), 0))
            left = np.flatnonzero((index[:-1] % 2 == 0) & ~head[1:])
            if not len(left):
                return
            self._add(name - np.arange(len(left)), starts[left], lengths[left], lengths[left + 1])
            name -= len(left)
            lengths = lengths.copy()
            lengths[left] += lengths[left + 1]
            kept = np.ones(len(rows), dtype=bool)
            kept[left + 1] = False
            starts, lengths, rows = starts[kept], lengths[kept], rows[kept]

    def _add(self, names, starts, left, right):
        if len(names):
            self._places.append((names, starts.copy(), starts + left, starts + left + right))


def _across(numbers, equal: Equality, first, middle, last):
    """(boundary, start, end, period) of stretches across each boundary, inside first .. last, long enough.

    A run of four periods has two of them on one side of the boundary. So for each period it is enough to
    compare the two periods that follow the boundary, and the two before it; what agrees is then stretched.
    """
    out = []
    whole = (last - first) // LEAST_TIMES
    for after in (True, False):
        side = np.minimum(((last - middle) if after else (middle - first)) // 2, whole)
        index = np.flatnonzero(side > 0)
        ends = np.cumsum(side[index])
        begin = 0
        while begin < len(index):
            base = ends[begin - 1] if begin else 0
            stop = max(int(np.searchsorted(ends, base + STEP, side="right")), begin + 1)
            own = index[begin:stop]
            begin = stop
            counts = side[own]
            node = np.repeat(own, counts)
            period = ranges(counts) + 1
            m = middle[node]
            hit = numbers[m] == numbers[m + period] if after else numbers[m - 1] == numbers[m - 1 - period]
            node, period, m = node[hit], period[hit], m[hit]
            hit = equal(m, m + period, period) if after else equal(m - 2 * period, m - period, period)
            node, period, m = node[hit], period[hit], m[hit]
            a, b = (m, m + period) if after else (m - period, m)
            start = a - equal.backward(a, b, a - first[node])
            end = b + equal.forward(a, b, last[node] - b)
            long = end - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
            out.append((node[long], start[long], end[long], period[long]))
    node, start, end, period = (np.concatenate(c) for c in zip(*out)) if out else [np.zeros(0, dtype=np.int64)] * 4
    return _smallest_period(node, start, end, period)


def _smallest_period(node, start, end, period):
    """Of equal stretches the one with the smallest period: it is the period of the run."""
    order = np.lexsort((period, end, start, node))
    node, start, end, period = node[order], start[order], end[order], period[order]
    new = np.ones(len(node), dtype=bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[new], start[new], end[new], period[new]


def _merged(start, end, period):
    """Stretches of one period that share a whole period are one; the rest is left as it is."""
    if not len(start):
        return start, end, period
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    _, group = np.unique(period, return_inverse=True)
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * far) - group * far
    new = np.ones(len(start), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - period[1:])
    at = np.flatnonzero(new)
    return start[at], np.maximum.reduceat(end, at), period[at]


def runs(numbers: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a slice, sorted by start, then period.

    `rows` tells the text of every word; positions are those of the slice.
    """
    grammar = Grammar(numbers, rows)
    equal = Equality(numbers)
    node, start, end, period = _across(numbers, equal, grammar.first, grammar.middle, grammar.last)
    # From one place of a nonterminal to all of them.
    lo = np.searchsorted(grammar.owner, node, side="left")
    counts = np.searchsorted(grammar.owner, node, side="right") - lo
    each = np.repeat(np.arange(len(node)), counts)
    shift = grammar.place[lo[each] + ranges(counts)] - grammar.first[node[each]]
    start, end, period = _merged(start[each] + shift, end[each] + shift, period[each])
    _, start, end, period = _smallest_period(np.zeros_like(start), start, end, period)
    _check(numbers, start, end, period)
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _check(numbers, start, end, period):
    """An exact look at the words of every run: they repeat, and do not go on beyond it."""
    for s, e, p in zip(start.tolist(), end.tolist(), period.tolist()):
        if not np.array_equal(numbers[s : e - p], numbers[s + p : e]):
            raise ArithmeticError("two different stretches of words have equal residues")


def _rewritten(ids: list, found: Words) -> np.ndarray:
    """For every word the word that stands there instead: the texts of some ids get a periodic end."""
    at = np.arange(len(found.starts))
    for row, doc_id in enumerate(ids):
        lo, hi = int(found.bounds[row]), int(found.bounds[row + 1])
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        n, g = hi - lo, h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            at[lo + a : hi] = lo + a + np.arange(n - a) % p
    return at


def _of_slice(ids: list, part: Slice, rewrite: bool) -> pa.RecordBatch:
    found = words(part)
    numbers, texts = word_numbers(part, found)
    if rewrite:
        numbers = numbers[_rewritten(ids, found)]
    start, end, period = runs(numbers, found.rows)
    # A word goes if a run holds it after the run's first period.
    change = np.zeros(len(numbers) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change[:-1]) == 0
    row = np.searchsorted(found.bounds, start, side="right") - 1
    table = pa.StructArray.from_arrays(
        [pa.array(start - found.bounds[row]), pa.array(end - start), pa.array(period)], fields=list(_RUN.value_type)
    )
    listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, found.bounds).astype(np.int32)), table)
    bounds = np.searchsorted(np.flatnonzero(kept), found.bounds)
    left = texts.take(pa.array(numbers[kept]))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds), left), pa.scalar(b" ", left.type))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(found.counts), listed, joined.cast(pa.large_string())], schema=_ARROW
    )


def periodic_runs(docs: DataFrame, rewrite: bool = False) -> DataFrame:
    """doc_id, n_words, runs, collapsed: one row per row of `docs`.

    A run is a stretch of words with a smallest period q, at least max(6, 4 q) words long, that goes on on
    neither side; it has start (word number), length and period, and runs are listed by start, then period.
    `collapsed` are the words, joined by spaces, that no run holds after its first period. With `rewrite`
    the texts of a tenth of the ids first get a periodic end, as the query's contract asks.

    Null texts are empty and have no words and no runs; repeated rows are repeated, a null id counts as an
    empty one, an empty table gives no rows, and columns other than doc_id and text are not looked at.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part in slices(batch.column(1)):
                yield _of_slice(ids[part.first : part.last], part, rewrite)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(find, SCHEMA)


def periodic_runs_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (null without one), and the digests of the runs and of what is left."""

    def line(run):
        return F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))

    # The greatest length, then the smallest start, then the smallest period.
    ranked = F.transform(
        "runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    )
    best = F.array_max(ranked)
    found = periodic_runs(docs, rewrite=True).withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
