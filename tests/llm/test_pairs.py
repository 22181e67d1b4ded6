"""Pairs of similar sets: few are compared, and no link of a bucket is lost, by either way through a bucket."""

import numpy as np
import pytest

from tagloom.llm import line_duplicates, lsh
from tagloom.llm import textcols as T
from tagloom.llm.scratch import Scratch


def _similar(x, y):
    common = len(np.intersect1d(x, y))
    return 100 * common >= 80 * (len(x) + len(y) - common)


@pytest.mark.parametrize("crowd", [1024, 8])
def test_families_of_unlike_lines(spark, monkeypatch, crowd):
    """Families whose members resemble each other by some 0.7 and copies of some members by 0.8 and more."""
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    lines = {}
    for family in range(3):
        base = [word() for _ in range(50)]
        for i in range(60):
            changed = base.copy()
            for j in rng.choice(50, 4, replace=False):
                changed[j] = base[(j + i) % 50]
            lines[len(lines)] = " ".join(changed)
            if i % 10 == 0:
                lines[len(lines)] = " ".join(changed[:-2])
    sets = {i: line_duplicates._set(x) for i, x in lines.items()}
    # A bucket of all, one of each family and one of all the even ones.
    items = [(i, [7, 100 + i // 66, 8 + i % 2]) for i in lines]
    items = spark.createDataFrame(items, "id long, bands array<long>")
    names = ["id", "n", "members", *[f"w{i}" for i in range(lsh.PARITY)]]
    bits = lsh.parities([T.mix64(sets[i], 9) for i in lines]).to_pylist()
    table = spark.createDataFrame(
        [(i, len(sets[i]), x, *b.values()) for (i, x), b in zip(lines.items(), bits)],
        "id long, n long, members string, " + ", ".join(f"{w} long" for w in names[3:]),
    ).selectExpr("id", "n", "members", f"struct({', '.join(names[3:])}) AS bits")
    compared = []

    def counted(pairs, *args):
        compared.extend(frozenset((r.a, r.b)) for r in pairs.collect())
        return confirmed(pairs, *args)

    confirmed = lsh.confirmed
    monkeypatch.setattr(lsh, "confirmed", counted)
    monkeypatch.setattr(lsh, "CROWD", crowd, raising=False)
    found, _ = lsh.similar_components(items, lambda ids: table.join(ids, "id", "left_semi"), 80, Scratch(spark, "test"), line_duplicates.TEXTS)
    parent = {i: i for i in lines}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {frozenset((a, b)) for a in lines for b in range(a) if _similar(sets[a], sets[b])}
    for a, b in map(sorted, links):
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in found.collect()}
    assert 10 < len(links) and len({root(i) for i in lines}) > 50
    assert {i: got.get(i, i) for i in lines} == {i: root(i) for i in lines}
    if crowd == 1024:
        assert len(compared) < 3 * len(lines) + 2 * len(links)


def test_parities_never_rule_out_similar_sets(spark):
    rng = np.random.default_rng(4)
    rows, want = [], []
    for n in (1, 5, 40, 400, 3000):
        for share in (0.0, 0.7, 0.8, 0.9, 1.0):
            common = rng.integers(0, 1 << 63, round(n * share), dtype=np.uint64)
            x, y = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, n - len(common), dtype=np.uint64)])) for _ in range(2))
            bits = lsh.parities([x, y]).to_pylist()
            rows.append((len(rows), len(x), *bits[0].values(), len(y), *bits[1].values()))
            want.append(_similar(x, y))
    one, two = ([f"{s}{i}" for i in range(lsh.PARITY)] for s in "xy")
    table = spark.createDataFrame(rows, "i long, n long, " + ", ".join(f"{c} long" for c in one) + ", m long, " + ", ".join(f"{c} long" for c in two))
    as_bits = lambda names: "struct(" + ", ".join(f"{c} AS w{i}" for i, c in enumerate(names)) + ")"
    table = table.selectExpr("i", "n", "m", f"{as_bits(one)} AS x", f"{as_bits(two)} AS y")
    got = {r.i: r.ok for r in table.select("i", lsh._parities_allow(80, table.n, table.x, table.m, table.y).alias("ok")).collect()}
    assert all(got[i] for i, similar in enumerate(want) if similar)
    assert sum(got.values()) < len(rows) - 5


def test_distinct_terms_of_many_documents_at_once():
    """As document by document, also across the pieces in which they are counted."""
    from tagloom.llm.packing import _distinct

    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 50_000, n).astype(np.uint16) for n in (1, 3, 300_000, 1, 7, 200_000, 90_000, 2)]
    got = {}
    for begin, end, term, doc, times in _distinct(docs):
        got |= {begin + i: (term[doc == i].tolist(), times[doc == i].tolist()) for i in range(end - begin)}
    assert got == {i: tuple(x.tolist() for x in np.unique(d, return_counts=True)) for i, d in enumerate(docs)}
    assert list(_distinct([])) == []
