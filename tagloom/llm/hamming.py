"""Exact nearest binary codes by multi-index hashing (operator 5)."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch

TOP = 10
QUERY_EVERY = 50


def codes(vectors: DataFrame, words: int | None = None) -> DataFrame:
    """vec_id, code: the signs of all values as bits of the longs w0, w1, … of a struct.

    There are as many longs as the longest vector needs (`words`, where that is known); shorter vectors have
    zero bits. Rows without a vector or id go.
    """
    rows = vectors.where("embedding IS NOT NULL AND vec_id IS NOT NULL")
    if words is None:
        longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 1
        words = max(1, math.ceil(longest / 64))
    bits = F.transform("embedding", lambda x: F.when(x > 0, F.expr("1L")).otherwise(F.expr("0L")))

    def placed(word: int) -> Column:
        return F.aggregate(
            F.slice(bits, 64 * word + 1, 64), F.struct(F.lit(0).alias("i"), F.lit(0).cast("long").alias("c")),
            lambda s, b: F.struct((s["i"] + 1).alias("i"), s["c"].bitwiseOR(F.call_function("shiftleft", b, s["i"])).alias("c")),
            lambda s: s["c"],
        )

    code = F.struct(*[placed(i).alias(f"w{i}") for i in range(words)])
    return rows.select(F.col("vec_id").cast("long"), code.alias("code"))


def _segments(n: int, words: int) -> list[tuple[int, int, int]]:
    """(word, shift, width) of the segments of a code, about log2(n) bits each, so that buckets stay small."""
    count = max(1, round(64 / max(8, min(20, math.log2(max(n, 2))))))
    edges = [64 * i // count for i in range(count + 1)]
    return [(w, a, b - a) for w in range(words) for a, b in zip(edges, edges[1:])]


def _segment(word: int, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(F.col("code")[f"w{word}"], shift).bitwiseAND(F.lit((1 << width) - 1))


def _distance(words: int) -> Column:
    different = [F.bit_count(F.col("query")[f"w{i}"].bitwiseXOR(F.col("code")[f"w{i}"])) for i in range(words)]
    return reduce(Column.__add__, different).cast("int")


def nearest(vectors: DataFrame, top: int = TOP, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, distance: the `top` other rows nearest to each query, ties by the smaller vec_id.

    Queries are the rows whose vec_id is divisible by `every`; rows with the query's own id are no neighbours.
    The table is indexed by the segments of its distinct codes. In round a, queries that are not done probe
    every segment value at distance a; then all codes within segments * (a + 1) - 1 have been seen, and a query
    is done when its last wanted distance is within that. Of the rows of one code, `top` of each id and
    2 * top in all, the smallest ids first, are all that can matter: at most `top` of them are the query's own.

    Rows without a vector or an id are left out; shorter vectors have zero bits; repeated ids are
    rows of their own. Fewer than `top` other rows: all of them. An empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "codes")
    rows = scratch.keep(codes(vectors))
    words = len(rows.schema["code"].dataType.fields)
    of_id = Window.partitionBy("code", "vec_id").orderBy(F.lit(0))
    by_id = Window.partitionBy("code").orderBy("vec_id")
    few = rows.withColumn("k", F.row_number().over(of_id)).where(F.col("k") <= top)
    few = few.withColumn("k", F.row_number().over(by_id)).where(F.col("k") <= 2 * top)
    distinct = few.groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = scratch.keep(distinct)
    totals = distinct.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("rows")).first()
    parts = _segments(totals.n, words)
    split = [F.struct(F.lit(j).alias("segment"), _segment(*p).alias("value")) for j, p in enumerate(parts)]
    held = F.size("ids").cast("long").alias("held")
    index = scratch.keep(distinct.select("code", held, F.explode(F.array(*split)).alias("s")).select("code", "held", "s.*"))
    wanted = rows.where(F.col("vec_id") % every == 0)
    # Rows with the query's own id lie at its own code; so many more are looked for.
    own = wanted.groupBy("code", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(top)).alias("own"))
    need = F.least(F.max("own") + top, F.lit(totals["rows"] or 0))
    open_codes = scratch.keep(own.groupBy(F.col("code").alias("query")).agg(need.alias("need")))
    best, done = None, []
    for radius in range(max(w for _, _, w in parts) + 1):
        probes = None
        for j, (word, shift, width) in enumerate(parts):
            if radius > width:
                continue
            masks = [sum(1 << b for b in c) for c in combinations(range(width), radius)]
            own = open_codes.withColumn("code", F.col("query")).withColumn("value", _segment(word, shift, width))
            mask = F.explode(F.from_json(F.lit(str(masks)), "array<long>"))
            own = own.select("query", "need", F.lit(j).alias("segment"), "value", mask.alias("mask"))
            own = own.select("query", "need", "segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
            probes = own if probes is None else probes.unionByName(own)
        # Both sides grow with the table, so they are merged: nothing is gathered in the driver to be broadcast.
        found = probes.join(index.hint("merge"), ["segment", "value"]).select("query", "need", "code", "held")
        found = found.withColumn("distance", _distance(words))
        # One shuffle by query; all that follows in a round is decided where the codes of a query lie together.
        everything = (found if best is None else best.unionByName(found)).repartition("query").distinct()
        of_query = Window.partitionBy("query")
        ranked = everything.withColumn("place", F.row_number().over(of_query.orderBy("distance", "code")))
        # Codes in order of distance until they hold enough rows, each of them one at least; all at the last distance stay.
        bound = F.max(F.when(F.col("place") == F.col("need"), F.col("distance"))).over(of_query)
        covered = len(parts) * (radius + 1) - 1
        seen = F.sum(F.when(F.col("distance") <= covered, F.col("held")).otherwise(F.lit(0).cast("long"))).over(of_query)
        kept = ranked.withColumns({"bound": bound, "done": seen >= F.col("need")}).where("bound IS NULL OR distance <= bound")
        kept = scratch.keep(kept.select("query", "need", "code", "held", "distance", "place", "done"))
        done.append(kept.where("done").select("query", "code", "distance"))
        still = kept.where("NOT done")
        best = still.select("query", "need", "code", "held", "distance")
        # Each query has met its own code at least, so that it has a first row.
        open_codes = still.where("place = 1").select("query", "need")
        if open_codes.isEmpty():
            break
    else:
        done.append(best.select("query", "code", "distance"))
    best = reduce(DataFrame.unionByName, done)
    pairs = best.join(distinct.hint("merge"), "code").select("query", "distance", F.explode("ids").alias("vec_id"))
    closest = Window.partitionBy("query").orderBy("distance", "vec_id")
    pairs = pairs.withColumn("place", F.row_number().over(closest)).where(F.col("place") <= 2 * top)
    asked = wanted.select(F.col("vec_id").alias("query_id"), F.col("code").alias("query"))
    hits = pairs.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("distance", "vec_id"))).alias("hits"))
    answered = asked.join(hits, "query").select(
        "query_id", F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, top).alias("hits")
    )
    return answered.select("query_id", F.posexplode("hits").alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "hit.vec_id", "hit.distance"
    )
