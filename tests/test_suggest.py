"""Suggestions for every user: exact, with most pairs never scored."""

import random

import pytest

from revlens.operators.suggest import top_for_all


def _plain(users, reviews, biz, n):
    seen, out = set(reviews), []
    for u, x in users:
        s = sorted((-min(max(x + b, 0.0), 5.0) if x is not None and b is not None else 0.0, i)
                   for i, b in biz if (u, i) not in seen)
        out += [(u, i, -v, k + 1) for k, (v, i) in enumerate(s[:n])]
    return sorted(out)


@pytest.mark.parametrize("spread,users_at", [(1.0, (0.0, 3.0)), (0.2, (4.5, 5.0)), (0.0, (2.0, 2.0))])
def test_equals_every_pair_scored(spark, spread, users_at):
    rng = random.Random(3)
    users = [(f"u{i}", rng.uniform(*users_at)) for i in range(40)] + [("none", None), ("low", -20.0)]
    biz = [(f"b{i:03d}", rng.uniform(-spread, spread)) for i in range(150)] + [("bn", None), ("b9", spread)]
    rng.shuffle(biz)
    reviews = [(rng.choice(users)[0], rng.choice(biz)[0]) for _ in range(300)] + [("u1", i) for i, _ in biz[:145]]
    got, report = top_for_all(spark.createDataFrame(users, "UserID string, value double"),
                              spark.createDataFrame(reviews, "UserID string, BusinessID string"),
                              spark.createDataFrame(biz, "BusinessID string, value double"), 5, block=8)
    assert sorted(tuple(r) for r in got.collect()) == _plain(users, reviews, biz, 5)
    assert report["pairs"] == 42 * 152 and report["scored"] <= report["pairs"] and report["rounds"] >= 1
    if spread == 1.0:
        assert report["scored"] < report["pairs"] * 0.5


def test_nothing_to_suggest(spark):
    u = spark.createDataFrame([("u", 1.0)], "UserID string, value double")
    b = spark.createDataFrame([("b", 1.0)], "BusinessID string, value double")
    r = spark.createDataFrame([("u", "b")], "UserID string, BusinessID string")
    assert top_for_all(u, r, b)[0].collect() == [] and top_for_all(u.limit(0), r, b)[0].collect() == []
    assert top_for_all(u, r, b.limit(0))[0].collect() == []
    assert [tuple(x) for x in top_for_all(u, r.limit(0), b)[0].collect()] == [("u", "b", 2.0, 1)]


@pytest.mark.parametrize("n_biz", [200, 800])
def test_pairs_scored_do_not_grow_with_users_times_businesses(spark, n_biz):
    """Many businesses that all reach the upper cut: ties by id, for users of few values."""
    rng = random.Random(5)
    users = [(f"u{i}", (4.5, 4.9, 5.0)[i % 3]) for i in range(60)]
    biz = [(f"b{rng.randrange(10 ** 9):09d}", rng.choice((-0.3, 0.05, 0.2, 0.6))) for _ in range(n_biz)]
    low = sorted(i for i, b in biz if b == 0.6)
    reviews = [("u0", i) for i in low[:40]] + [("u1", low[0])]
    got, report = top_for_all(spark.createDataFrame(users, "UserID string, value double"),
                              spark.createDataFrame(reviews, "UserID string, BusinessID string"),
                              spark.createDataFrame(biz, "BusinessID string, value double"), 3, block=8)
    assert sorted(tuple(r) for r in got.collect()) == _plain(users, reviews, biz, 3)
    assert report["scored"] < 10 * n_biz  # 60 * n_biz pairs in all


def test_user_listed_twice(spark):
    u = spark.createDataFrame([("u", 1.0), ("u", 1.0), ("v", 2.0)], "UserID string, value double")
    b = spark.createDataFrame([("a", 1.0), ("b", 0.5)], "BusinessID string, value double")
    r = spark.createDataFrame([], "UserID string, BusinessID string")
    got = sorted(tuple(x) for x in top_for_all(u, r, b, 2)[0].collect())
    assert got == [("u", "a", 2.0, 1)] * 2 + [("u", "a", 2.0, 2)] * 2 + [("v", "a", 3.0, 1), ("v", "b", 2.5, 2)]
