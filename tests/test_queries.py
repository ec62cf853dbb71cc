"""Registered queries: contract, oracle agreement on sf0.001, plan shape."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from revlens.plans import catalog as C
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
ML_KEYS = {"txt_topic_words", "txt_topic_dist", "txt_topic_rows",
           "rec_train_eval", "rec_top10_model"}


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return str(v)


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_contract():
    q, o = C.QUERIES, C.ORACLE
    assert set(o) <= set(q) <= set(E.queries())
    assert set(q) - set(o) == ML_KEYS
    assert len(q) == 50


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["CheckinWeekDayNo", "CheckinWeekDayName", "CheckinHour", "CheckinCount"]
    assert df.count() > 0


DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
              "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("key", sorted(C.ORACLE))
def test_oracle(spark, con, key):
    sdf = C.QUERIES[key](spark, SF_SMALL)
    con.sql(C.ORACLE[key]).create_view("o0", replace=True)  # as the driver's check reads it
    types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in sdf.schema.fields}
    assert types == {r[0]: r[1] for r in con.execute("DESCRIBE o0").fetchall()}
    s = sdf.toPandas()
    o = con.sql("SELECT * FROM o0").df()
    assert _rows(s) == _rows(o)


@pytest.mark.parametrize("key", sorted(C.ORACLE))
def test_no_python_rows(spark, key):
    plan = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_pruning(spark):
    plan = E.queries()["chk_hours"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # events is read with only the two columns the query needs
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_rows_and_wide_categories_agree(spark):
    from revlens.functions.text import sanitize_name
    from revlens.operators import prepare as P
    from revlens.plans import catalog as C
    from pyspark.sql import functions as F
    rows = C.categories(spark, SF_SMALL)
    wide = P.category_wide(rows)
    melted = wide.select("BusinessID", F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in wide.columns[1:]]), F.array(*[F.col(c) for c in wide.columns[1:]]))))
    from_wide = {(r.BusinessID, r.key) for r in melted.where("value").collect()}
    from_rows = {(r.BusinessID, "CAT_" + r.k) for r in rows.select("BusinessID", sanitize_name(F.col("Category"))
                                                                     .alias("k")).collect()}
    assert from_wide == from_rows


def test_top10_properties(spark):
    from revlens.plans import catalog as C
    top = E.queries()["rec_top10"](spark, SF_SMALL).collect()
    per_user = {}
    for r in top:
        per_user.setdefault(r.UserID, []).append(r)
    assert per_user and all(len(v) <= 10 for v in per_user.values())
    for v in per_user.values():
        stars = [r.FinalStar for r in sorted(v, key=lambda r: r["rank"])]
        assert stars == sorted(stars, reverse=True) and all(0 <= s <= 5 for s in stars)
    visited = {(r.UserID, r.BusinessID) for r in C.reviews(spark, SF_SMALL).select("UserID", "BusinessID").collect()}
    assert not any((r.UserID, r.BusinessID) in visited for r in top)


def test_sorted_outputs_follow_their_keys(spark):
    q = E.queries()
    hm = [(r.CheckinWeekDayNo, r.CheckinHour) for r in q["chk_heatmap"](spark, SF_SMALL).collect()]
    assert hm == sorted(hm)
    cc = [r.BusinessCount for r in q["biz_city_counts"](spark, SF_SMALL).collect()]
    assert cc == sorted(cc, reverse=True)
    gs = [r.BusinessStars for r in q["geo_group_share"](spark, SF_SMALL).collect()]
    assert gs == sorted(gs, reverse=True)
