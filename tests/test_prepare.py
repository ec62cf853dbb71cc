"""ETL operators on hand-written rows in the raw shapes (FIXTURES.md section 4)."""

from pyspark.sql import Row

from revlens import schemas
from revlens.operators import prepare as P

ATTRS = ["BikeParking", "WiFi", "Ambience", "GoodForMeal"]


def _biz(spark, rows):
    return spark.createDataFrame(rows, schemas.business_raw(ATTRS))


def _b(bid, state="ON", postal="M5V 2T6", stars=4.0, cats="Chinese, Food", is_open=1,
       attrs=("True", "u'free'", "{'romantic': False, 'casual': True}", None), name="x"):
    return (bid, name, state, "Toronto", postal, 43.6, -79.4, stars, 10, is_open, cats,
            Row(*attrs))


def test_business_filters(spark):
    prov = spark.createDataFrame([("ON", "Ontario"), ("QC", "Quebec"), ("ON", "Ontario")],
                                 schemas.PROVINCE_RAW)
    raw = _biz(spark, [
        _b("ok"), _b("closed", is_open=0), _b("unlisted", state="NY"),
        _b("short", postal="M5V 2T"), _b("nostars", stars=None), _b("nocats", cats=None),
    ])
    out = P.business_clean(raw, prov)
    assert [r.BusinessID for r in out.collect()] == ["ok"]  # duplicate province does not repeat rows
    assert "BusinessStars" in out.columns  # stars are kept


def test_category_rows_and_wide(spark):
    prov = spark.createDataFrame([("ON", "Ontario")], schemas.PROVINCE_RAW)
    raw = _biz(spark, [_b("a", cats=" chinese ,Food, ,A&B"), _b("b", cats="AB, Food")])
    b = P.business_clean(raw, prov)
    rows = sorted((r.BusinessID, r.Category) for r in P.category_rows(b).collect())
    assert rows == [("a", ""), ("a", "A&B"), ("a", "CHINESE"), ("a", "FOOD"), ("b", "AB"), ("b", "FOOD")]
    wide = P.category_wide(P.category_rows(b))
    # A&B and AB sanitise to one column and are aggregated together.
    assert sorted(wide.columns) == ["BusinessID", "CAT_", "CAT_AB", "CAT_CHINESE", "CAT_FOOD"]
    got = {r.BusinessID: r.asDict() for r in wide.collect()}
    assert got["a"]["CAT_AB"] is True and got["b"]["CAT_AB"] is True
    assert got["b"]["CAT_CHINESE"] is None


def test_attribute_flatten(spark):
    prov = spark.createDataFrame([("ON", "Ontario")], schemas.PROVINCE_RAW)
    raw = _biz(spark, [
        _b("a", attrs=(None, "u'free'", "{'romantic': False, 'casual': True}", "{'dessert' True}")),
        _b("b", attrs=("True", "'no'", "{'touristy': None}", "None")),
    ])
    rows = sorted((r.BusinessID, r.attr_key, r.attr_val)
                  for r in P.attribute_rows(P.business_clean(raw, prov)).collect())
    assert rows == [
        ("a", "Ambience_casual", "TRUE"), ("a", "Ambience_romantic", "FALSE"),
        ("a", "BikeParking", None), ("a", "WiFi", "FREE"),
        ("b", "Ambience_touristy", None), ("b", "BikeParking", "TRUE"),
        ("b", "GoodForMeal", None), ("b", "WiFi", "NO"),
    ]  # the pair without a colon gives no row; u'..' quoting is removed; None stays null


def test_checkin_explode(spark):
    prov = spark.createDataFrame([("ON", "Ontario")], schemas.PROVINCE_RAW)
    b = P.business_clean(_biz(spark, [_b("a"), _b("b")]), prov)
    chk = spark.createDataFrame([
        ("a", ""), ("a", "2020-01-02 03:04:05"),
        ("b", " 2020-02-01 10:00:00 , ,2020-03-01 11:00:00, not a time"),
        ("zz", "2020-01-01 00:00:00"),
    ], schemas.CHECKIN_RAW)
    out = sorted((r.BusinessID, str(r.CheckinDate)) for r in P.checkin_explode(chk, b).collect())
    # empty pieces are dropped, pieces that are no time are kept without one
    assert out == [("a", "2020-01-02 03:04:05"), ("b", "2020-02-01 10:00:00"), ("b", "2020-03-01 11:00:00"),
                   ("b", "None"), ("b", "None")]


def test_review_clean(spark):
    prov = spark.createDataFrame([("ON", "Ontario")], schemas.PROVINCE_RAW)
    b = P.business_clean(_biz(spark, [_b("a")]), prov)
    rev = spark.createDataFrame([
        ("r1", "a", "u1", "line1\nline2", "2019-12-31", 5.0, 0, 0, 0),
        ("r2", "a", "u1", "t", "2019-12-31", -1.0, 0, 0, 0),
        ("r3", "a", "u1", "t", "2019-12-31", 6.0, 0, 0, 0),
        ("r4", "a", "u1", None, "2019-12-31", 3.0, 0, 0, 0),
        ("r5", "a", "u2", "t", "2019-12-31 10:00:00", 0.0, 0, 0, 0),
        ("r6", "zz", "u1", "t", "2019-12-31", 3.0, 0, 0, 0),
    ], schemas.REVIEW_RAW)
    out = {r.ReviewID: r for r in P.review_clean(rev, b).collect()}
    assert sorted(out) == ["r1", "r5"]
    assert out["r1"].Review == "line1 line2"
    assert str(out["r5"].Date) == "2019-12-31"


def _u(uid, friends, elite, n=1):
    return (uid, "n", *([0] * 11), 0, 0, 0, friends, 0, elite, n, 3.5, "2015-03-04")


def test_users(spark):
    reviews = spark.createDataFrame([("u1",), ("u1",), ("u2",)], "UserID string")
    raw = spark.createDataFrame([
        _u("u1", "f1, f2, f1", "2015,2016,2015"), _u("u2", "None", ""), _u("u3", "f9", "2010"),
    ], schemas.USER_RAW)
    valid = P.user_valid(raw, reviews)
    assert sorted(r.UserID for r in valid.collect()) == ["u1", "u2"]  # one row per user
    assert valid.columns == schemas.USER_COLS
    fr = sorted(tuple(r) for r in P.user_friends(raw, reviews).collect())
    assert fr == [("u1", "f1"), ("u1", "f2")]
    el = sorted(tuple(r) for r in P.user_elites(raw, reviews).collect())
    assert el == [("u1", "2015"), ("u1", "2016")]


def test_postcode_filter(spark):
    pc = spark.createDataFrame([("M1A", "Not assigned", "x"), ("M1B", "B", "Not assigned"),
                                ("M1C", "B", "N")], "Postcode string, Borough string, Neighbourhood string")
    assert [r.Postcode for r in P.postcode_filter(pc).collect()] == ["M1C"]


def test_pivot_of_many_names_is_a_map(spark):
    """50,000 names: every business with every one of its names, no error."""
    rows = spark.range(60_000).selectExpr("concat('b', CAST(id % 700 AS STRING)) AS BusinessID",
                                          "concat('n ', CAST(id % 50000 AS STRING)) AS Category", "true AS Served")
    rows = rows.unionByName(spark.createDataFrame([("none", None, True)], rows.schema))
    wide = P.category_wide(rows)
    assert wide.columns == ["BusinessID", "CAT"]
    got = {r.BusinessID: r.CAT for r in wide.collect()}
    assert len(got) == 701 and got["none"] == {} and sum(map(len, got.values())) == rows.distinct().count() - 1
    assert got["b5"]["n5"] is True and got["b5"]["n705"] is True
    few = rows.where("BusinessID IN ('b1', 'none')")
    assert set(P.category_wide(few).columns) == {"BusinessID", *("CAT_" + k for k in got["b1"])}
    assert P.category_wide(few, max_values=3).columns == ["BusinessID", "CAT"]
