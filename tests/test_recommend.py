"""Recommender: unvisited pairs, clamping, top-N with ties, model round trip."""

import datetime as dt

import pytest

from revlens.operators import recommend as R
from revlens.session import shared_dir
from revlens.sources.io import load_model, save_model

SENT = "BusinessID string, avg_neg double, avg_neu double, avg_pos double, avg_composite_score double, " \
       "Name string, ZipCode string, Latitude double, Longitude double"


def _data(spark):
    users = spark.createDataFrame([("u1", "A", 3, 4.5), ("u2", "B", 1, 1.0), ("u3", "C", 2, 3.0)],
                                  "UserID string, UserName string, ReviewCount long, AverageStars double")
    reviews = spark.createDataFrame([("b1", "u1", 5.0, dt.date(2020, 1, 2)), ("b2", "u2", 1.0, dt.date(2020, 3, 4))],
                                    "BusinessID string, UserID string, ReviewStars double, Date date")
    sent = spark.createDataFrame([
        ("b1", 0.1, 0.5, 0.4, 0.3, "B1", "M1A1A1", 43.0, -79.0),
        ("b2", 0.9, 0.1, 0.0, -0.9, "B2", "M1B1A1", 43.1, -79.1),
        ("b3", 0.0, 0.0, 0.9, 0.9, "B3", "M2A1A1", 43.2, -79.2),
        ("b4", 0.0, 0.0, 0.9, 0.9, "B4", None, 43.3, -79.3),
    ], SENT)
    return users, reviews, sent


def test_candidates_exclude_visited(spark):
    users, reviews, sent = _data(spark)
    c = R.candidates(users, reviews, sent, n_users=2, as_of="2024-01-05")
    pairs = sorted((r.UserID, r.BusinessID) for r in c.collect())
    # u1 reviewed b1, u2 reviewed b2; b4 has no postcode; u3 is outside the sample
    assert pairs == [("u1", "b2"), ("u1", "b3"), ("u2", "b1"), ("u2", "b3")]
    assert {r.ReviewDayOfYear for r in c.collect()} == {5}
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_top_n_clamps_and_ties(spark):
    users, reviews, sent = _data(spark)
    c = R.fixed_score(R.candidates(users, reviews, sent, n_users=3))
    top = R.top_n(c, 1).collect()
    assert len(top) == 3 and all(r["rank"] == 1 for r in top)
    for r in top:
        assert 0.0 <= r.FinalStar <= 5.0
    u1 = [r for r in top if r.UserID == "u1"][0]
    assert u1.BusinessID == "b3" and u1.FinalStar == 5.0  # 4.5 + 2.7 clamped to 5
    u2 = R.top_n(c.where("UserID = 'u2'"), 5).collect()
    assert [r.BusinessID for r in u2] == ["b3", "b1"]


def test_top_n_plan_limits_before_shuffle(spark):
    users, reviews, sent = _data(spark)
    plan = R.top_n(R.fixed_score(R.candidates(users, reviews, sent, 3)), 10)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_train_save_load_predict(spark):
    rows = []
    for i in range(120):
        rows.append((f"b{i % 7}", f"u{i % 11}", "n", i % 5 + 1, 1.0 + (i % 4), float(i % 5 + 1), i % 365 + 1,
                     "B", f"M{i % 3}A", f"M{i % 3}", 43.0 + i % 7 / 10, -79.0, 0.1, 0.5, 0.4, 0.3))
    cols = ("BusinessID string, UserID string, UserName string, UserReviewCount long, UserAverageStars double, "
            "ReviewStars double, ReviewDayOfYear int, BusinessName string, BusinessPostalCode string, "
            "BusinessNeighborhood string, Latitude double, Longitude double, AverageNegative double, "
            "AverageNeutral double, AveragePositive double, AverageComposite double")
    feats = spark.createDataFrame(rows, cols)
    model, m = R.train_eval(feats, seed=7, max_iter=2, max_depth=3, max_bins=32)
    assert m["rmse"] >= 0
    path = shared_dir(spark, "models/test")
    save_model(model, path)
    again = load_model(path)
    unseen = feats.limit(3).withColumn("BusinessNeighborhood", feats.BusinessNeighborhood.substr(1, 0))
    assert R.predict(again, unseen).count() == 3  # unseen neighbourhood label is kept, not an error
    missing = feats.limit(2).withColumn("UserAverageStars", feats.UserAverageStars * None)
    assert R.predict(again, missing).count() == 2  # a missing feature never drops a candidate
    assert R.predict(again, missing).where("PredictedReviewStar IS NULL").count() == 0


def test_many_neighbourhoods_and_missing_numbers_train(spark):
    rows = spark.range(600).selectExpr(
        "concat('b', id) AS BusinessID", "'u' AS UserID", "'n' AS UserName", "id % 9 AS UserReviewCount",
        "CASE WHEN id % 4 = 0 THEN NULL ELSE 3.0D END AS UserAverageStars", "CAST(id % 5 + 1 AS DOUBLE) AS ReviewStars",
        "CAST(id % 365 + 1 AS INT) AS ReviewDayOfYear", "'B' AS BusinessName", "'M' AS BusinessPostalCode",
        "concat('N', id % 200) AS BusinessNeighborhood", "43.0D + id % 7 AS Latitude", "CAST(NULL AS DOUBLE) AS Longitude",
        "0.1D AS AverageNegative", "0.5D AS AverageNeutral", "0.4D AS AveragePositive", "0.3D AS AverageComposite")
    model = R.fit(rows, max_iter=1, max_depth=2)
    assert model.transform(rows.withColumn("Longitude", rows.Latitude * None)).count() == 600


def test_split_is_a_property_of_the_row(spark):
    rows = spark.range(4000).selectExpr("concat('b', id % 37) AS BusinessID", "concat('u', id) AS UserID",
                                        "CAST(id % 365 AS INT) AS ReviewDayOfYear", "CAST(id % 5 AS DOUBLE) AS ReviewStars")

    def sides(d, seed=1):
        return {r.UserID: r.side for r in d.withColumn("side", R.split_side(d, seed)).collect()}
    a = sides(rows)
    assert a == sides(rows.repartition(7).orderBy("ReviewStars")) and a != sides(rows, 2)
    assert 0.72 < sum(a.values()) / len(a) < 0.78
    nulls = rows.selectExpr("BusinessID", "CAST(NULL AS STRING) AS UserID", "CAST(NULL AS INT) AS ReviewDayOfYear",
                            "CAST(NULL AS DOUBLE) AS ReviewStars").limit(3)
    assert None not in sides(nulls).values()


def test_metrics_are_those_of_the_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    d = spark.range(500).selectExpr("CAST(id % 5 AS DOUBLE) AS ReviewStars", "id % 7 * 0.5D AS prediction")
    m = R.regression_metrics(d).first()
    ev = RegressionEvaluator(predictionCol="prediction", labelCol="ReviewStars")
    assert m.n == 500 and all(abs(m[k] - ev.setMetricName(k).evaluate(d)) < 1e-9 for k in ("r2", "rmse"))
    assert R.regression_metrics(d.where("ReviewStars = 1")).first().r2 is None
    assert tuple(R.regression_metrics(d.limit(0)).first()) == (0, None, None)


def test_training_rows_hold_what_is_read(spark, monkeypatch):
    """Names and codes that neither fit, split nor evaluation read are not written."""
    class Stop(Exception):
        pass

    def cut(df, *_):
        raise Stop(df.columns)
    monkeypatch.setattr(R, "persist_cut", cut)
    rows = spark.createDataFrame([("b", "u", "name", "n", 4.0, *[1.0] * 9)],
                                 ["BusinessID", "UserID", "BusinessName", "BusinessNeighborhood", "ReviewStars",
                                  *[c for c in R.FEATURES if c != "BusinessNeighborhoodIndexed"]])
    with pytest.raises(Stop) as e:
        R.train_eval(rows)
    assert set(e.value.args[0]) == set(rows.columns) - {"BusinessName"}
