"""Topic model as a table: special functions, bound, planted topics, inference."""

import math
import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import topics as L

ROWS = "group string, doc string, term string, weight double"


def test_special_functions(spark):
    xs = (0.01, 0.1, 1 / 6, 0.5, 1.0, 2.5, 30.0, 1e4)
    d = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in d.select("x", L.lgamma(F.col("x")).alias("l"), L.digamma(F.col("x")).alias("d")).collect():
        assert abs(r.l - math.lgamma(r.x)) < 1e-9
        h = r.x * 1e-4
        assert abs(r.d - (math.lgamma(r.x + h) - math.lgamma(r.x - h)) / (2 * h)) < 1e-5 * max(1, abs(r.d))


def _planted(seed=1, n=30, k=2):
    """Two groups; each document speaks of one of two themes, and some common words."""
    rng = random.Random(seed)
    rows = {}
    for g in ("a", "b"):
        for i in range(n):
            for _ in range(40):
                t = f"{g}{i % k}_{rng.randrange(15)}" if rng.random() < 0.85 else f"common{rng.randrange(8)}"
                rows[g, f"{g}{i}", t] = rows.get((g, f"{g}{i}", t), 0.0) + 1.0
    return [(*key, w) for key, w in rows.items()]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.createDataFrame(_planted(), ROWS)
    return rows, *L.fit_topics(rows, k=2, seed=4, max_iter=10, check_every=1)


def test_bound_never_falls(fitted):
    _, _, bounds = fitted
    assert len(bounds) > 3 and all(b >= a - 1e-6 * abs(a) for a, b in zip(bounds, bounds[1:]))


def test_planted_topics_are_recovered(fitted):
    rows, model, _ = fitted
    themes = {}
    for r in L.top_terms(model, 8).collect():
        own = {t.split("_")[0] for t in r.terms}
        assert len(own) == 1 and own.pop()[0] == r.group
        themes.setdefault(r.group, set()).add(r.terms[0].split("_")[0])
    assert themes == {g: {f"{g}{i}" for i in range(2)} for g in "ab"}


def test_inference(spark, fitted):
    rows, model, _ = fitted
    got = {r.doc: r.topics for r in L.infer(model, rows, iterations=4).collect()}
    assert len(got) == 60 and all(abs(sum(v) - 1) < 1e-9 and max(v) > 0.8 for v in got.values())
    assert len({got[f"a{i}"].index(max(got[f"a{i}"])) for i in (0, 2, 6)}) == 1
    new = spark.createDataFrame([("a", "new", "a1_3", 5.0), ("a", "odd", "unknown", 2.0), ("b", "zero", "b1_3", 0.0)], ROWS)
    found = {r.doc: r.topics for r in L.infer(model, new, iterations=4).collect()}
    assert set(found) == {"new"} and found["new"].index(max(found["new"])) == got["a1"].index(max(got["a1"]))


def test_same_topics_at_other_partitionings(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for n in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows = spark.createDataFrame(_planted(2, 12), ROWS).repartition(int(n))
        model = L.fit_topics(rows, k=2, seed=1, max_iter=3)[0]
        got.append(sorted((r.group, r.term, round(r.l0, 6), round(r.l1, 6)) for r in model.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1]


def test_no_rows(spark):
    model, bounds = L.fit_topics(spark.createDataFrame([], ROWS), k=2, max_iter=2)
    assert model.collect() == [] and L.top_terms(model).collect() == []
    assert L.infer(model, spark.createDataFrame([("a", "d", "t", 1.0)], ROWS), iterations=1).collect() == []


def test_rows_are_not_shuffled_again(spark):
    """Terms are summed where their dealt rows lie; only documents are exchanged."""
    rows = spark.createDataFrame(_planted(3, 8), ROWS)
    model = rows.select("group", "term").distinct().withColumns({"l0": F.lit(1.0), "l1": F.lit(2.0)})
    theta = L._theta(rows.select("doc").distinct().withColumns({"g0": F.lit(1.0), "g1": F.lit(3.0)}), 2)
    dealt, beta = L._dealt(rows, 4), L._dealt(L._beta(model, 2), 4)
    assert dealt.count() == rows.count() and beta.count() == model.count()
    got = L._shared(dealt, beta, F.broadcast(theta), 2).groupBy("group", "term").agg(*L._sums(2))
    plan = got._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "hashpartitioning(group" not in plan
    whole = L._shared(rows, L._beta(model, 2), theta, 2).agg(F.sum("p0"), F.sum("p1")).first()
    assert abs(sum(whole) - rows.agg(F.sum("weight")).first()[0]) < 1e-6
    assert abs(got.agg(F.sum("p0")).first()[0] - whole[0]) < 1e-9
    dealt.unpersist(), beta.unpersist()
