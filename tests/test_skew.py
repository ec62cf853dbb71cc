"""A user owning a third of all reviews: the join is split, not piled on one task."""

import datetime as dt

from revlens.operators import recommend as R

SENT = "BusinessID string, avg_neg double, avg_neu double, avg_pos double, avg_composite_score double, " \
       "Name string, ZipCode string, Latitude double, Longitude double"


def test_hot_user_join_is_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30_000
        reviews = spark.range(n).selectExpr(
            "concat('b', CAST(id % 50 AS STRING)) AS BusinessID",
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('u', CAST(id % 997 AS STRING)) END AS UserID",
            "CAST(id % 5 + 1 AS DOUBLE) AS ReviewStars", "DATE '2020-01-01' AS Date")
        users = spark.range(997).selectExpr("concat('u', CAST(id AS STRING)) AS UserID", "'n' AS UserName",
                                            "id AS ReviewCount", "3.0D AS AverageStars") \
            .union(spark.createDataFrame([("hot", "h", 10_000, 4.0)], "UserID string, UserName string, "
                                                                       "ReviewCount long, AverageStars double"))
        sent = spark.range(50).selectExpr("concat('b', CAST(id AS STRING)) AS BusinessID", "0.1D AS avg_neg",
                                          "0.5D AS avg_neu", "0.4D AS avg_pos", "0.3D AS avg_composite_score",
                                          "'B' AS Name", "'M1A1A1' AS ZipCode", "43.0D AS Latitude",
                                          "-79.0D AS Longitude")
        out = R.features(reviews, users, sent)
        assert len(out.collect()) == n  # every review kept exactly once
        plan = out._jdf.queryExecution().executedPlan().toString()  # final adaptive plan
        assert "isSkewJoin=true" in plan or "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
