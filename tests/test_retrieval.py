"""Lists by norm bounds against all pairs, and fold-in against a half-step of the fit."""

import random

import numpy as np
import pytest
from tests.conftest import TESTDATA

from tagloom.models import als, ratings, retrieval
from tagloom.sources import sample

SF = str(TESTDATA / "sf0.01")


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    rows = ratings.product_ratings(sample.logs(spark, SF))
    return rows, als.fit_saved(rows, "productId", str(tmp_path_factory.mktemp("m") / "model"))


def _factors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id int, features array<float>")


def _all_pairs(users, items, k):
    want = {}
    for u, x in users:
        x = np.array(x, dtype=np.float32).astype(float)
        scored = sorted((-float(sum(a * b for a, b in zip(x, np.array(v, dtype=np.float32).astype(float)))), i) for i, v in items)
        want[u] = [i for _, i in scored[:k]]
    return want


def _got(found):
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.user, -r.score, r.item)):
        got.setdefault(r.user, []).append(r.item)
    return got


@pytest.mark.parametrize("k, count", [(1, 90), (10, 250), (400, 50)])
def test_equals_all_pairs_with_ties(spark, k, count):
    rnd = random.Random(k)
    # Small whole numbers: many equal scores and lengths; some users and items are zero or opposite.
    items = [(i, [rnd.randrange(-2, 3) * (20 if i % 37 == 0 else 1) for _ in range(3)]) for i in range(count)]
    users = [(u, [rnd.randrange(-2, 3) for _ in range(3)]) for u in range(25)] + [(99, [0, 0, 0])]
    found = retrieval.top_items_by_norm(_factors(spark, users), _factors(spark, items), k, 3, first=32, round_bytes=40 * 64)
    assert _got(found) == _all_pairs(users, items, k)


def test_rounds_end_early_and_leave_the_lists_alone(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    items = [(i, rnd.normal(size=4) / (1 + i) ** 0.7) for i in range(600)]
    users = [(u, rnd.normal(size=4)) for u in range(40)]
    seen = []
    scored = retrieval._scored
    monkeypatch.setattr(retrieval, "_scored", lambda u, *a: seen.append(u.count()) or scored(u, *a))
    found = retrieval.top_items_by_norm(_factors(spark, users), _factors(spark, items), 3, 4, first=16)
    assert _got(found) == _all_pairs(users, items, 3)
    assert seen[0] == 40 and seen[-1] < 40 and len(seen) < 7 and sum(seen) < 40 * 6


def test_empty_sides(spark):
    some, none = _factors(spark, [(1, [1, 2])]), _factors(spark, [])
    assert retrieval.top_items_by_norm(none, some, 2, 2).count() == 0
    assert retrieval.top_items_by_norm(some, none, 2, 2).count() == 0


def test_lists_of_a_model(spark, fitted):
    _, model = fitted
    want = {r.userId: [(x.productId, x.rating) for x in r.recommendations] for r in als.recommend(model, 10).collect()}
    got = {r.userId: [(x.productId, x.rating) for x in r.recommendations] for r in retrieval.recommend_by_norm(model, "productId", 10).collect()}
    assert set(got) == set(want)
    for user, items in want.items():
        np.testing.assert_allclose([r for _, r in got[user]], [r for _, r in items], atol=1e-5)
        gaps = np.diff([r for _, r in items])
        if len(gaps) and np.abs(gaps).min() > 1e-5:  # no two scores that floats may exchange
            assert [i for i, _ in got[user]] == [i for i, _ in items]


def test_candidates_alone_are_scored(spark, fitted):
    rows, model = fitted
    got = retrieval.recommend_from(model, "productId", rows, 3).collect()
    seen = {(r.userId, r.productId) for r in rows.collect()}
    assert got and all((r.userId, x.productId) in seen for r in got for x in r.recommendations)


def test_fold_in_is_the_half_step_of_the_fit(spark, fitted):
    rows, model = fitted
    own = {r.id: r.features for r in model.userFactors.collect()}
    folded = {r.id: r.features for r in retrieval.fold_in(model, rows, "productId").collect()}
    assert set(folded) == set(own)
    for user, features in own.items():
        np.testing.assert_allclose(folded[user], features, rtol=2e-3, atol=2e-4)


def test_fold_in_of_new_users_equals_numpy(spark, fitted):
    _, model = fitted
    items = {r.id: np.array(r.features, dtype=float) for r in model.itemFactors.collect()}
    known = sorted(items)
    new = [(10**6, known[0], 3.0), (10**6, known[5], 1.0), (10**6, known[7], -2.0), (10**6 + 1, known[2], 1.0), (10**6 + 1, -5, 4.0), (10**6 + 2, known[3], 0.0)]
    table = spark.createDataFrame(new, "userId int, productId int, rating double")
    got = {r.id: np.array(r.features) for r in retrieval.fold_in(model, table, "productId").collect()}
    assert set(got) == {10**6, 10**6 + 1}
    gram = sum(np.outer(v, v) for v in items.values())
    for user in got:
        own = [(items[i], r) for u, i, r in new if u == user and i in items]
        a = gram + sum(10.0 * abs(r) * np.outer(v, v) for v, r in own) + np.eye(10) * sum(r > 0 for _, r in own)
        b = sum(((1 + 10.0 * r) * v for v, r in own if r > 0), np.zeros(10))
        np.testing.assert_allclose(got[user], np.linalg.solve(a, b), rtol=1e-4, atol=1e-5)
    assert retrieval.recommend_folded(model, table, "productId", 5).count() == 2
