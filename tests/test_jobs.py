"""End-to-end jobs on JSON / CSV files derived from the sf0.001 tables."""

import os

from pyspark.sql import functions as F

from revlens.plans import catalog as C
from revlens.plans import jobs as J
from revlens.plans import params as PR
from revlens.plans import views as V
from revlens.sources import io
from revlens.streaming import checkin_stream
from tests.conftest import SF_SMALL


def _raw(spark, root):
    d = SF_SMALL
    V.provinces(spark, d).write.json(f"{root}/provinces.json")
    V.business_raw(spark, d).write.json(f"{root}/business.json")
    V.checkin_raw(spark, d).write.json(f"{root}/checkin.json")
    V.review_raw(spark, d).write.json(f"{root}/review.json")
    V.user_raw(spark, d).write.json(f"{root}/user.json")


def test_jobs_end_to_end(spark, tmp_path):
    raw, clean, out = str(tmp_path / "raw"), str(tmp_path / "clean"), str(tmp_path / "out")
    _raw(spark, raw)
    J.etl(spark, raw, clean)
    # the file-based pipeline agrees with the registered queries
    assert spark.read.parquet(f"{clean}/reviews").count() == C.reviews(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{clean}/users").count() == C.users(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{clean}/checkins").count() == C.checkins(spark, SF_SMALL).count()
    assert set(spark.read.parquet(f"{clean}/business_wide").columns) == \
        set(C.q_etl_business_wide(spark, SF_SMALL).columns)

    J.profile(spark, clean, f"{out}/profile", [PR.PROVINCE], PR.CITY, PR.CUISINES, attr_main=PR.ATTR_MAIN_KEY)
    assert spark.read.option("header", True).csv(f"{out}/profile/BusinessCuisines_{PR.PROVINCE}").count() > 0
    heat = spark.read.option("header", True).csv(f"{out}/profile/CheckinHeatMap")
    total = heat.select(F.sum(F.col("CheckinCount").cast("long"))).first()[0]
    assert total == spark.read.parquet(f"{clean}/checkins").count()
    assert len([f for f in os.listdir(f"{out}/profile/CheckinHeatMap") if f.endswith(".csv")]) == 1

    lookup = str(tmp_path / "lookup")
    V.postcodes(spark, SF_SMALL).write.option("header", True).csv(f"{lookup}/postcode.csv")
    V.ethnicity(spark, SF_SMALL).write.option("header", True).csv(f"{lookup}/ethnicity.csv")
    V.labour(spark, SF_SMALL).write.option("header", True).csv(f"{lookup}/labour.csv")
    J.geo(spark, clean, lookup, f"{out}/geo", PR.CITY_LIKE, PR.CATEGORY_LIKE, PR.GROUP_COLUMNS)
    assert spark.read.option("header", True).csv(f"{out}/geo/GroupShare").count() > 0
    assert spark.read.option("header", True).csv(f"{out}/geo/LabourRatio").count() > 0

    held, cached = len(io.cut_folders()), spark.sparkContext._jsc.getPersistentRDDs().size()
    J.text(spark, clean, f"{out}/text", city=PR.CITY)
    assert len(io.cut_folders()) == held
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    scored = spark.read.option("header", True).csv(f"{out}/text/Sentiment_for_alltext")
    assert scored.count() == spark.read.parquet(f"{clean}/reviews").join(
        spark.read.parquet(f"{clean}/business").where(F.col("City") == PR.CITY), "BusinessID").count()
    assert spark.read.parquet(f"{out}/text/Topic_business_dist").count() > 0

    sent = str(tmp_path / "sentiment")
    V.rec_sentiment(spark.read.parquet(f"{clean}/reviews"), spark.read.parquet(f"{clean}/business")) \
        .write.option("header", True).csv(sent)
    metrics = J.train(spark, clean, sent, f"{out}/rec")
    assert metrics["rmse"] >= 0
    assert len(io.cut_folders()) == held
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    J.recommend(spark, clean, sent, f"{out}/rec/TrainedModel", f"{out}/rec", n_users=5)
    top = spark.read.option("header", True).csv(f"{out}/rec/TestModel")
    assert 0 < top.count() <= 5 * PR.TOP_N
    assert top.groupBy("UserID").count().where("count > 10").count() == 0


def test_checkin_stream(spark, tmp_path):
    src, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    business = C.business(spark, SF_SMALL)
    V.checkin_raw(spark, SF_SMALL).write.json(src)
    q = checkin_stream(spark, src, business, sink, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(sink).count() == C.checkins(spark, SF_SMALL).count()


def test_review_stream(spark, tmp_path):
    from revlens.streaming import review_stream
    src, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    V.review_raw(spark, SF_SMALL).write.json(src)
    q = review_stream(spark, src, C.business(spark, SF_SMALL), sink, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(sink).count() == C.reviews(spark, SF_SMALL).count()


def test_cli_usage():
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "revlens.plans.jobs", "--help"], cwd=root,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0
    for job in ("etl", "profile", "geo", "text", "train", "recommend"):
        assert job in out.stdout
