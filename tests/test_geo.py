"""Neighbourhood joins: padded headers, unmatched postcodes, zero population."""

from revlens.operators import geo as G

BIZ = "BusinessID string, Name string, City string, PostalCode string, Categories string, " \
      "Latitude double, Longitude double, BusinessStars double"


def _biz(spark):
    return spark.createDataFrame([
        ("1", "a", "Toronto", "M1A 1A1", "Indian, Food", 0.0, 0.0, 4.0),
        ("2", "b", "Toronto", "M1B 1A1", "Indian", 0.0, 0.0, 5.0),
        ("3", "c", "Toronto", "M9Z 1A1", "Indian", 0.0, 0.0, 3.0),   # unmatched postcode
        ("4", "d", "Markham", "M1A 1A1", "Indian", 0.0, 0.0, 2.0),   # other city
    ], BIZ)


def _post(spark):
    return spark.createDataFrame([("M1A", "East", "North"), ("M1B", "East", "South")],
                                 "Postcode string, Borough string, Neighbourhood string")


def test_group_share(spark):
    eth = spark.createDataFrame([("North", "100", "25", "x"), ("South", "0", "3", "1")],
                                "` Neighbourhood ` string, ` Total Population` string, ` South Asian ` string, "
                                "` Black ` string")
    out = G.group_share(_biz(spark), _post(spark), eth, "%Toronto%", "%Indian%", ["South Asian", "Black"])
    rows = [tuple(r) for r in out.collect()]
    # best rated first; zero population and unparsable counts give null shares
    assert [r[0] for r in rows] == ["2", "1", "3"]
    assert rows[0][5:] == ("South", None, None)
    assert rows[1][5:] == ("North", 0.25, None)
    assert rows[2][5:] == (None, None, None)


def test_labour_ratio(spark):
    lab = spark.createDataFrame([("North", "7", "x", "100", "10", "8", "2"), ("South", "8", "x", "50", "20", None, "1")],
                                "`Neighbourhood ` string, ` NeighbourhoodId` string, ` CombinedIndicators` string, "
                                "` TotalPopulation` string, ` LabourForceCategory ` string, ` InLabourForce ` string, "
                                "` Unemployed ` string")
    out = {r.Neighbourhood: (r.BusinessStars, r.ratio_emply)
           for r in G.labour_ratio(_biz(spark), _post(spark), lab, "%Toronto%").collect()}
    # South has a missing labour value and the unmatched business has no neighbourhood: both dropped
    assert out == {"North": (4.0, 0.8)}
