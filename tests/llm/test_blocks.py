"""Bucket keys in blocks, lines cut and hashed many at a time."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import line_duplicates as L
from tagloom.llm import lsh
from tagloom.llm import textcols as T

TEXTS = ["Ab cdefghij\n\n \tTwo words here \r\nx", None, "", "short", "a line of its own\nÄÖÜ äöü ÀÉ 日本語の行です\x0b\nab cdefghij", "x\ny\nz"]


@pytest.mark.parametrize("texts", [TEXTS, TEXTS[::-1], ["x\ny"], [None]])
def test_lines_and_their_shingles(texts):
    (part,) = T.slices(pa.array(texts, pa.string()))
    found = L._lines(part, 1)
    want = [
        (r, i, line.strip(" \t\n\v\f\r").encode().lower())
        for r, text in enumerate(texts)
        for i, line in enumerate((text or "").split("\n"))
        if line.strip(" \t\n\v\f\r")
    ]
    assert list(zip(found["row"], found["line"])) == [(r, i) for r, i, _ in want]
    assert found["h1"].tolist() == [int.from_bytes(hashlib.blake2b(x, digest_size=16).digest()[:8], "little") for _, _, x in want]
    wanted = np.arange(len(want)) % 3 != 1
    owner, hashes = L._shingles(found, wanted)
    for k, (_, _, line) in enumerate(want):
        own = T.mix64(L._set(line.decode()), 9) if wanted[k] and len(line.decode()) >= L.SHINGLE else np.zeros(0, np.uint64)
        assert set(hashes[owner == k].tolist()) == set(own.tolist())


def test_most_buckets_pass_the_shuffle_in_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lsh, "HANDED", 64)
    monkeypatch.setattr(lsh, "GROUPED", 32)
    rng = np.random.default_rng(3)
    rows = [(int(i), [int(k) for k in rng.integers(-(2**63), 2**63, 3)] + [7, -(2**62) + i % 40]) for i in range(-150, 150)]
    rows += [(5, []), rows[0], rows[-1]]
    spark.createDataFrame(rows, "id long, bands array<long>").repartition(3).write.parquet(str(tmp_path / "items"))
    shared = lsh.shared_buckets(spark.read.parquet(str(tmp_path / "items")))
    holders = collections.defaultdict(set)
    for i, bands in rows:
        for key in bands:
            holders[key].add(i)
    want = {k: (min(v), max(v)) for k, v in holders.items() if len(v) > 1}
    got = shared.collect()
    assert len(got) == len(want) and {r.key: (r.hub, r.other) for r in got} == want
    assert all(r.n > 2 for r in got if len(holders[r.key]) > 2)
    # No row for each key is shuffled.
    assert "Generate" not in shared._jdf.queryExecution().executedPlan().toString()
