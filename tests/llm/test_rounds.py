"""A round of the search for codes moves its rows three times: the probes, the index, and what was found by query."""

import numpy as np

from tagloom.llm.hamming import nearest
from tagloom.llm.scratch import Scratch


def test_shuffles_of_a_round_and_its_answers(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(700, 64))
    vectors[100:160] = vectors[0]  # one very common vector, queries among its rows
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    plans, keep = [], Scratch.keep

    def kept(self, df):
        if "distance" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df)

    monkeypatch.setattr(Scratch, "keep", kept)
    rows = nearest(table).collect()
    assert len(plans) > 1 and all(p.count("Exchange hashpartitioning") <= 3 for p in plans)
    bits = vectors > 0
    for q in range(0, 700, 50):
        far = (bits != bits[q]).sum(axis=1)
        want = sorted((int(far[i]), i) for i in range(700) if i != q)[:10]
        assert [(r.distance, r.vec_id) for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] == want
