"""Exact components of similar sets from banded signatures.

Buckets propose pairs, the full sets confirm them. A bucket never emits all its pairs:
each member is compared with the least one. After that only sets that are still in
different components are compared: within buckets of bounded size every pair that sizes and
parities of the members leave possible, elsewhere some challengers at a time, and only where
they share one of their rarest members and its place in both leaves room for the similarity.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm import textcols as T
from tagloom.llm.components import components
from tagloom.llm.narrow import possible, residues
from tagloom.llm.scratch import Scratch

#: Holders of a rare member compared with all others in the first extra round; four times as many in each next one.
CHALLENGERS = 256
#: Open buckets of at most so many sets are compared pair by pair, larger ones by the rarest members of their sets.
CROWD = 1024
#: Items whose buckets one group brings together, about, and bucket keys that a task collects before it hands them on.
GROUPED, HANDED = 1 << 14, 1 << 20
#: Sorted keys made into blocks at once; only memory depends on it.
SORTED = 1 << 16
#: Longs of the parities of a set: of so many classes of members times 64, whether it holds an odd number of each.
PARITY = 16
PARITY_TYPE = f"struct<{', '.join(f'w{i}: long' for i in range(PARITY))}>"


def parities(hashes: list[np.ndarray]) -> pa.Array:
    """The column `bits` (PARITY_TYPE) of sets of well mixed 64-bit hashes."""
    words, classes = np.zeros((len(hashes), PARITY), dtype=np.uint64), 64 * PARITY
    for first in range(0, len(hashes), 256):  # so many at a time that the counts stay small
        some = hashes[first : first + 256]
        owner = np.repeat(np.arange(len(some)) * classes, [len(x) for x in some])
        members = (np.concatenate(some) % np.uint64(classes)).astype(np.int64)
        odd = (np.bincount(owner + members, minlength=len(some) * classes) & 1).astype(np.uint8)
        words[first : first + 256] = np.packbits(odd, bitorder="little").view("<u8").reshape(-1, PARITY)
    columns = [pa.array(np.ascontiguousarray(words[:, i]).view(np.int64)) for i in range(PARITY)]
    return pa.StructArray.from_arrays(columns, names=[f"w{i}" for i in range(PARITY)])


def _parities_allow(percent: int, n, bits, other_n, other_bits) -> Column:
    """False only for sets that cannot be similar: every parity that differs is a member that one of them lacks."""
    differ = reduce(Column.__add__, [F.bit_count(bits[f"w{i}"].bitwiseXOR(other_bits[f"w{i}"])) for i in range(PARITY)])
    return differ.cast("long") * (100 + percent) <= (n + other_n) * (100 - percent)


@dataclass(frozen=True)
class Reading:
    """How `members` of a set are read.

    common: adds the size of the intersection of x and y. each: (id, member) of every member.
    """

    common: Callable[[DataFrame], DataFrame]
    each: Callable[[DataFrame], DataFrame]


#: Sets stored as arrays of distinct 64-bit hashes.
HASHES = Reading(
    common=lambda pairs: pairs.withColumn("common", F.size(F.array_intersect("x", "y")).cast("long")),
    each=lambda sets: sets.select("id", F.explode("members").alias("member")),
)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, reading: Reading = HASHES) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of their sets (id, n, members, perhaps bits)."""
    known = [c for c in ("n", "bits") if c in sets.columns]

    def of(names: dict[str, str], by: str) -> DataFrame:
        return sets.select(F.col("id").alias(by), *[F.col(c).alias(name) for c, name in names.items()])

    # Sizes and parities alone rule out most of what cannot be similar, before any set is moved.
    sized = pairs.join(of({c: f"{c}_a" for c in known}, "a"), "a").join(of({c: f"{c}_b" for c in known}, "b"), "b")
    sized = sized.where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & (F.least("n_a", "n_b") > 0))
    if "bits" in known:
        sized = sized.where(_parities_allow(percent, F.col("n_a"), F.col("bits_a"), F.col("n_b"), F.col("bits_b")))
    sized = sized.select("a", "b", "n_a", "n_b")
    both = reading.common(sized.join(of({"members": "x"}, "a"), "a").join(of({"members": "y"}, "b"), "b"))
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    return both.where(F.col("common") * 100 >= union * percent).select("a", "b")


def _pair(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _prefixes(ids: DataFrame, sets: DataFrame, percent: int, reading: Reading) -> DataFrame:
    """(key, id, label, n, place, p1, p2): the members of each set of `ids` (id, label) of which any similar set must share
    one, and the two before each.

    Members are ordered by the number of sets among `ids` that hold them, rarest first. Similar sets have
    at least percent of n in common, so that the rarest common member is among the first n - ceil(percent of n) + 1
    of both. Members that no other set holds count for the place and are left out. A set is ordered by
    itself: no more rows than it has members meet in a window.
    """
    own = sets.join(ids, "id")
    each = reading.each(own)
    held = each.groupBy("member").agg(F.count("*").alias("held")).where("held > 1")
    of_set = Window.partitionBy("id")
    in_order = of_set.orderBy("held", "member")
    before = {f"p{i}": F.lag("member", i).over(in_order) for i in (1, 2)}
    rank = F.row_number().over(in_order)
    placed = each.join(held, "member").withColumns({"rank": rank, "shared": F.count("*").over(of_set), **before})
    placed = placed.join(own.select("id", "n", "label"), "id").withColumn("place", F.col("n") - F.col("shared") + F.col("rank"))
    least = f"CAST(({percent} * n + 99) DIV 100 AS long)"
    return placed.where(f"shared >= {least} AND place <= n - {least} + 1").select(
        F.col("member").alias("key"), "id", "label", "n", "place", "p1", "p2"
    )


def _could_reach(percent: int, n, place, other_n, other_place):
    """False only where sets whose rarest common member has these places cannot reach the similarity."""
    most = F.lit(1) + F.least(n - place, other_n - other_place)
    return most * (100 + percent) >= (n + other_n) * percent


def _met_before() -> Column:
    """True only where one of the two members before the shared one is shared as well: the pair has met there."""
    same = [F.col(p) == F.col(f"own_{q}") for p in ("p1", "p2") for q in ("p1", "p2")]
    return F.coalesce(reduce(Column.__or__, [F.coalesce(x, F.lit(False)) for x in same]), F.lit(False))


def _within(opened: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of sets of different labels in the buckets `opened` (key, id, label) that may be similar.

    A pair is made in the first of its buckets alone.
    """
    own = opened.groupBy("id", "label").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    own = own.join(sets.select("id", "n", "bits"), "id").select("*", F.posexplode("keys").alias("nth", "key"))
    own = own.select("key", "id", "label", "n", "bits", F.slice("keys", F.lit(1), F.col("nth")).alias("before"))
    other = own.select("key", *[F.col(c).alias(f"own_{c}") for c in own.columns if c != "key"])
    n, own_n = F.col("n"), F.col("own_n")
    possible_pair = (
        (F.col("id") > F.col("own_id"))
        & (F.col("label") != F.col("own_label"))
        & (F.least(n, own_n) * 100 >= F.greatest(n, own_n) * percent)
        & _parities_allow(percent, n, F.col("bits"), own_n, F.col("own_bits"))
        & ~F.arrays_overlap("before", "own_before")
    )
    return own.hint("merge").join(other, "key").where(possible_pair).select(F.col("id").alias("a"), F.col("own_id").alias("b"))


def _in_order(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    return key[order], ids[order]


def _by_key(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct key of a sorted column, its least and greatest id and its number of rows."""
    first = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), dtype=bool), key[1:] != key[:-1]]))
    if not len(first):
        return key, ids, ids, first
    return key[first], np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first), np.diff(np.append(first, len(key)))


def shared_buckets(items: DataFrame) -> DataFrame:
    """(key, n, hub, other) of the buckets of several ids: their least and greatest id; n is over 2 where there may be more.

    items: id, bands, a stored table. Most buckets hold one id, so that a row for each would be the bulk of all that is
    shuffled: a task sorts the keys of many items and hands them on by ranges, a block of keys and one of ids a range.
    However large a bucket, it adds three entries to a block at most.
    """
    ranges = max(1, -(-items.count() // GROUPED))

    def block(key: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        key, low, high, n = _by_key(key, ids)
        times = np.where(low == high, 1, np.minimum(n, 3))
        both = np.repeat(high, times)
        both[np.cumsum(times) - times] = low
        key = np.repeat(key, times)
        place = ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        spans = list(zip(first.tolist(), np.append(first[1:], len(place)).tolist()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(place[first], pa.int64()),
                pa.array([key[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([both[a:b].tobytes() for a, b in spans], pa.binary()),
            ],
            names=["place", "keys", "ids"],
        )

    def blocks(keys: list[np.ndarray], ids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Blocks of all that was collected; the lists are emptied, and no key lies in two pieces."""
        key, own = np.concatenate(keys), np.concatenate(ids)
        keys.clear()
        ids.clear()
        key, own = _in_order(key, own)
        begin = 0
        while begin < len(key):
            end = int(np.searchsorted(key, key[min(begin + SORTED, len(key)) - 1], side="right"))
            yield block(key[begin:end], own[begin:end])
            begin = end

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, held = [], [], 0
        for batch in batches:
            size = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            keys.append(batch.column(1).flatten().to_numpy().view(np.uint64))
            ids.append(np.repeat(batch.column(0).to_numpy(), size))
            held += len(keys[-1])
            if held >= HANDED:
                yield from blocks(keys, ids)
                held = 0
        if held:
            yield from blocks(keys, ids)

    def gather(blocks: pa.Table) -> pa.Table:
        keys, ids = (np.frombuffer(b"".join(blocks.column(c).to_pylist()), dtype=t) for c, t in (("keys", "<u8"), ("ids", "<i8")))
        key, low, high, n = _by_key(*_in_order(keys, ids))
        several = low != high
        return pa.table({"key": key[several].view(np.int64), "n": n[several].astype(np.int64), "hub": low[several], "other": high[several]})

    dealt = items.select(F.col("id").cast("long"), "bands").where("id IS NOT NULL").mapInArrow(T.frugal(deal), "place long, keys binary, ids binary")
    return dealt.groupBy("place").applyInArrow(gather, "key long, n long, hub long, other long")


def similar_components(
    items: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    percent: int,
    scratch: Scratch,
    reading: Reading = HASHES,
) -> tuple[DataFrame, DataFrame]:
    """(node, component) of the items that are linked with others, and the confirmed links (a, b).

    items: id, bands (array of bucket keys), a stored table; an id may occur again with the same bands or none. fetch:
    (distinct ids) -> id, members (the full set as `reading` reads it) and, unless members are an array,
    n (its size); with bits (their `parities`) fewer sets are compared. Links are confirmed on the full sets; a component
    holds everything that the links of all buckets connect.
    """
    buckets = items.select("id", F.explode("bands").alias("key"))
    shared = scratch.keep(shared_buckets(items.select("id", "bands")))
    crowded = shared.where("n > 2").select("key", "hub")
    members = scratch.keep(
        possible(buckets, residues(crowded, "key"), "key").join(crowded, "key").where("id <> hub").distinct()
    )
    pairs = scratch.keep(
        shared.select(*_pair("hub", "other")).unionByName(members.select(*_pair("hub", "id"))).distinct()
    )
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = fetch(ids)
    sets = scratch.keep(sets if "n" in sets.columns else sets.withColumn("n", F.size("members").cast("long")))
    links = scratch.keep(confirmed(pairs, sets, percent, reading))
    found = scratch.keep(components(links, scratch))
    # What is left in buckets of several components: in small ones pair by pair, else where the rarest members agree.
    opened = _still_open(scratch.keep(_labelled(members.select("key", "id"), found)))
    if "bits" in sets.columns:
        opened = scratch.keep(opened.withColumn("crowd", F.count("*").over(Window.partitionBy("key"))))
        pairs = scratch.keep(_within(opened.where(F.col("crowd") <= CROWD), sets, percent))
        more = scratch.keep(confirmed(pairs, sets, percent, reading))
        if not more.isEmpty():
            links = scratch.keep(links.unionByName(more).distinct())
            found = _merged(found, more, scratch)
        opened = _still_open(scratch.keep(_labelled(opened.where(F.col("crowd") > CROWD).select("key", "id"), found)))
    open_ids = scratch.keep(opened.select("id", "label").distinct())
    if open_ids.isEmpty():
        return found, links
    rows, few = scratch.keep(_prefixes(open_ids, sets, percent, reading)), CHALLENGERS
    while True:
        open_rows = scratch.keep(_still_open(rows))
        if open_rows.isEmpty():
            return found, links
        sizes = open_rows.groupBy("key", "label").agg(F.count("*").alias("rows"))
        largest = sizes.groupBy("key").agg(F.max(F.struct("rows", "label"))["label"].alias("largest"))
        first = Window.partitionBy("key").orderBy("id")
        challengers = scratch.keep(
            open_rows.join(largest, "key")
            .where("label <> largest")
            .withColumn("nth", F.row_number().over(first))
            .where(F.col("nth") <= few)
            .select(
                "key",
                F.col("id").alias("by"),
                F.col("label").alias("own"),
                F.col("n").alias("own_n"),
                F.col("place").alias("own_place"),
                F.col("p1").alias("own_p1"),
                F.col("p2").alias("own_p2"),
            )
        )
        reach = _could_reach(percent, F.col("n"), F.col("place"), F.col("own_n"), F.col("own_place"))
        pairs = scratch.keep(
            open_rows.join(challengers, "key")
            .where((F.col("label") != F.col("own")) & reach & ~_met_before())
            .select(*_pair("id", "by"))
            .distinct()
        )
        more = scratch.keep(confirmed(pairs, sets, percent, reading))
        done = challengers.select("key", F.col("by").alias("id"))
        rows, few = open_rows.join(done, ["key", "id"], "left_anti"), 4 * few
        if not more.isEmpty():
            links = scratch.keep(links.unionByName(more).distinct())
            found = _merged(found, more, scratch)
            rows = _labelled(rows.drop("label"), found)
        rows = scratch.keep(rows)


def _merged(found: DataFrame, more: DataFrame, scratch: Scratch) -> DataFrame:
    """`found` with the components joined that the links `more` connect: a graph of components, not of items."""
    known = found.select(F.col("node").alias("id"), "component")
    ends = more
    for end in ("a", "b"):
        ends = ends.join(known.withColumnRenamed("id", end), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    joined = scratch.keep(components(ends, scratch))
    now = joined.select(F.col("node").alias("was"), F.col("component").alias("now"))
    moved = found.join(now, F.col("component") == F.col("was"), "left").select("node", F.coalesce("now", "component").alias("component"))
    # Items that were alone are nodes of the graph of components.
    single = joined.join(found.select("node"), "node", "left_anti")
    return scratch.keep(moved.unionByName(single))


def _labelled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` (id, ...) and their label: the component, or the id of an item that has none."""
    known = found.select(F.col("node").alias("id"), "component")
    return rows.join(known, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")


def _still_open(rows: DataFrame) -> DataFrame:
    """`rows` (key, id, label, ...), a stored table, of the buckets that hold several components."""
    split = rows.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    return rows.join(split.select("key"), "key", "left_semi")
