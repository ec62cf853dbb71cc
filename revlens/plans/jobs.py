"""End-to-end batch jobs: read inputs, call operators, write outputs.

    python -m revlens.plans.jobs etl        --input DIR --out DIR
    python -m revlens.plans.jobs profile    --input DIR --out DIR
    python -m revlens.plans.jobs geo        --input DIR --lookup DIR --out DIR
    python -m revlens.plans.jobs text       --input DIR --out DIR
    python -m revlens.plans.jobs train      --input DIR --sentiment PATH --out DIR
    python -m revlens.plans.jobs recommend  --input DIR --sentiment PATH --model PATH --out DIR

Cities, patterns, provinces, cuisines, population groups, the day and the sizes
are flags (``--help``); their defaults are those of the analyses this library
reproduces.

``etl`` reads the raw JSON files (provinces, business, checkin, review,
user) and writes the clean tables as Parquet; the other jobs read those. Lines
that are no JSON or do not fit go to the table ``quarantine``, with the reason.
Each clean table is written before the next step reads it, so the written
table is the lineage cut: a lost executor later costs a re-read, not a
re-run of the whole ETL.
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import schemas
from revlens.operators import geo as G
from revlens.operators import prepare as P
from revlens.operators import profile as Q
from revlens.operators import recommend as R
from revlens.operators import sentiment as S
from revlens.operators import text as T
from revlens.plans import params as PR
from revlens.sources import io

RAW_FILES = {"provinces": "provinces.json", "business": "business.json", "checkin": "checkin.json",
             "review": "review.json", "user": "user.json"}
CLEAN = ["business", "business_wide", "categories", "attributes", "checkins", "reviews", "users",
         "user_friends", "user_elites"]


# The parameters of the analyses.
CITY, CITY_LIKE, CATEGORY_LIKE = "Toronto", "%Toronto%", "%Indian%"
PROVINCES = ["AB", "ON", "QC"]
GROUPS = ["South Asian"]
ATTR_MAIN, ATTR_SUBSET = "RestaurantsPriceRange2", "Ambience"
TOP_K, THRESHOLD, N_USERS, TOP_N = 10, 3.0, 50, 10
# The cuisines, as category names without blanks.
CUISINES = [
    "Canadian(New)", "Chinese", "American(Traditional)", "Italian", "Mexican", "MiddleEastern", "Japanese", "Indian",
    "Mediterranean", "AsianFusion", "French", "American(New)", "Vietnamese", "Korean", "Taiwanese", "Caribbean",
    "Greek", "Filipino", "LatinAmerican", "Lebanese", "Portuguese", "Pakistani", "Hawaiian", "Persian/Iranian",
    "British", "African", "ModernEuropean", "Afghan", "Turkish", "Irish", "Arabian", "Belgian", "German", "Spanish",
    "Brazilian", "Himalayan/Nepalese", "International", "Russian", "Colombian", "SriLankan", "Ukrainian", "Venezuelan",
    "Argentine", "Australian", "Ethiopian", "Hungarian", "Malaysian", "Singaporean", "SouthAfrican", "Bangladeshi",
    "Egyptian", "Mongolian"]


def _business_schema(spark: SparkSession, path: str):
    """Attribute fields differ between releases: infer the raw schema once,
    from all records, and use it for the real read."""
    inferred = spark.read.json(path).schema
    if "attributes" not in inferred.fieldNames():
        return schemas.business_raw([])
    return schemas.business_raw(inferred["attributes"].dataType.fieldNames())


def etl(spark: SparkSession, input_dir: str, out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    src = {k: f"{input_dir}/{v}" for k, v in RAW_FILES.items()}
    dst = {k: f"{out_dir}/{k}" for k in CLEAN + ["provinces", "quarantine"]}
    start, bad = len(io.cut_folders()), []

    def raw(name, schema):
        """Good records of an input; the others go to the quarantine."""
        good, rest, _ = io.read_json_checked(spark, src[name], schema)
        bad.append(rest.select(F.lit(name).alias("input"), "file", "reason", "record"))
        return good

    prov = raw("provinces", schemas.PROVINCE_RAW)
    io.write_table(prov, dst["provinces"], fmt)
    braw = raw("business", _business_schema(spark, src["business"]))
    io.write_table(P.business_clean(braw, spark.read.format(fmt).load(dst["provinces"])), dst["business"], fmt)
    business = spark.read.format(fmt).load(dst["business"])
    cats = P.category_rows(business)
    io.write_table(cats, dst["categories"], fmt)
    attrs = P.attribute_rows(business)
    io.write_table(attrs, dst["attributes"], fmt)
    cats = spark.read.format(fmt).load(dst["categories"])
    attrs = spark.read.format(fmt).load(dst["attributes"])
    io.write_table(P.business_wide(business, P.category_wide(cats), P.attribute_wide(attrs)),
                   dst["business_wide"], fmt)
    chk = raw("checkin", schemas.CHECKIN_RAW)
    io.write_table(P.checkin_explode(chk, business), dst["checkins"], fmt)
    rev = raw("review", schemas.REVIEW_RAW)
    io.write_table(P.review_clean(rev, business), dst["reviews"], fmt)
    reviews = spark.read.format(fmt).load(dst["reviews"])
    usr = raw("user", schemas.USER_RAW)
    io.write_table(P.user_valid(usr, reviews), dst["users"], fmt)
    io.write_table(P.user_friends(usr, reviews), dst["user_friends"], fmt)
    io.write_table(P.user_elites(usr, reviews), dst["user_elites"], fmt)
    io.write_table(reduce(DataFrame.unionByName, bad), dst["quarantine"], fmt)
    io.release_cuts(spark, start)
    return dst


def _load(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}")


def profile(spark: SparkSession, clean_dir: str, out_dir: str, provinces: list[str] | None = None,
            city: str = CITY, cuisines: list[str] | None = None, k: int = TOP_K, attr_main: str = ATTR_MAIN,
            attr_subset: str = ATTR_SUBSET, preview: int = 0) -> None:
    """Every descriptive chart table as a CSV folder. ``preview`` > 0 prints
    that many rows of each."""
    b = _load(spark, clean_dir, "business").drop("Attributes")
    cats, attrs = _load(spark, clean_dir, "categories"), _load(spark, clean_dir, "attributes")
    chk, rev, usr = (_load(spark, clean_dir, n) for n in ("checkins", "reviews", "users"))
    one_file = {  # bounded by k or by the calendar
        **{f"BusinessCuisines_{p}": Q.top_cuisines(b, p, cuisines or CUISINES, k) for p in provinces or PROVINCES},
        "BusinessTopCategories": Q.top_categories(cats, k),
        "CheckinHeatMap": Q.checkin_heatmap(chk), "CheckinMonths": Q.checkin_months(chk),
        "CheckinDays": Q.checkin_days(chk), "CheckinHours": Q.checkin_hours(chk),
    }
    parts = {  # open domains: values, places, dates and counts of the data
        "BusinessProvinceAvgStars": Q.province_avg_stars(b), "BusinessAttrMain": Q.attr_main_dist(attrs, attr_main),
        "BusinessAttrSubset": Q.attr_subset_dist(attrs, attr_subset), "ReviewYears": Q.review_years(rev),
        "UserJoinYears": Q.user_join_years(usr), "UserReviewCounts": Q.user_review_buckets(usr, PR.BUCKET_WIDTH),
        "UserStarCounts": Q.user_star_floor(usr), "BusinessCityStars": Q.city_star_map(b, city),
        "BusinessCities": Q.city_counts(b), "ReviewOverYears": Q.review_star_trend(rev),
    }
    for names, write in ((one_file, io.write_small_csv), (parts, io.write_csv)):
        for name, df in names.items():
            write(df, f"{out_dir}/{name}")
            if preview:
                spark.read.option("header", True).csv(f"{out_dir}/{name}").show(preview, truncate=False)


def geo(spark: SparkSession, clean_dir: str, lookup_dir: str, out_dir: str,
        city_like: str = CITY_LIKE, category_like: str = CATEGORY_LIKE,
        groups: list[str] | None = None) -> None:
    """Lookup CSVs: postcode.csv, ethnicity.csv, labour.csv (headers, strings)."""
    b = _load(spark, clean_dir, "business")
    post = P.postcode_filter(io.strip_header(io.read_csv_strings(spark, f"{lookup_dir}/postcode.csv")))
    eth = io.read_csv_strings(spark, f"{lookup_dir}/ethnicity.csv")
    lab = io.read_csv_strings(spark, f"{lookup_dir}/labour.csv", schemas.LABOUR_COLS)
    io.write_csv(G.group_share(b, post, eth, city_like, category_like, groups or GROUPS),
                 f"{out_dir}/GroupShare")
    io.write_csv(G.labour_ratio(b, post, lab, city_like), f"{out_dir}/LabourRatio")


def text(spark: SparkSession, clean_dir: str, out_dir: str, city: str = CITY, threshold: float = THRESHOLD,
         n_topics: int = PR.LDA_K) -> None:
    start = len(io.cut_folders())
    b, rev = _load(spark, clean_dir, "business"), _load(spark, clean_dir, "reviews")
    cleaned = io.persist_cut(T.clean_reviews(rev, b, city), spark, "text-clean")
    io.write_table(T.review_tokens(cleaned), f"{out_dir}/ReviewTokens")
    scored = io.persist_cut(S.sentiment(cleaned.drop("clean_text")), spark, "text-scores")
    io.write_csv(scored, f"{out_dir}/Sentiment_for_alltext")
    io.write_csv(T.business_sentiment(scored, b, city), f"{out_dir}/BusinessSentiment")
    words, dist = T.topics(T.merge_reviews(rev, b, city), threshold, n_topics, PR.LDA_SEED)
    io.write_small_csv(words.selectExpr("segment", "topic", "array_join(topic_word, ' ') AS topic_word"),
                       f"{out_dir}/Topic_words")
    io.write_table(dist, f"{out_dir}/Topic_business_dist")
    io.write_csv(T.topic_rows(dist), f"{out_dir}/Topic_exploded")
    io.release_cuts(spark, start)


def _sentiment(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The business sentiment table: a CSV folder with header (as the text job
    writes it) or Parquet. CSV cells stay strings until the operator casts them."""
    return io.read_csv_strings(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)


def train(spark: SparkSession, clean_dir: str, sentiment_path: str, out_dir: str) -> dict:
    start = len(io.cut_folders())
    rows = R.features(_load(spark, clean_dir, "reviews"), _load(spark, clean_dir, "users"),
                      _sentiment(spark, sentiment_path))
    model, metrics = R.train_eval(rows, PR.SPLIT_SEED)
    io.save_model(model, f"{out_dir}/TrainedModel")
    io.release_cuts(spark, start)
    return metrics


def recommend(spark: SparkSession, clean_dir: str, sentiment_path: str, model_path: str,
              out_dir: str, n_users: int = N_USERS, as_of: str | None = None, n: int = TOP_N) -> None:
    """``as_of``: the day of the supposed reviews, today by default."""
    start = len(io.cut_folders())
    c = R.candidates(_load(spark, clean_dir, "users"), _load(spark, clean_dir, "reviews"),
                     _sentiment(spark, sentiment_path), n_users, as_of)
    io.write_csv(R.top_n(R.predict(io.load_model(model_path), c), n), f"{out_dir}/TestModel")
    io.release_cuts(spark, start)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="revlens")
    ap.add_argument("job", choices=["etl", "profile", "geo", "text", "train", "recommend"])
    ap.add_argument("--input", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--lookup", help="folder of postcode.csv, ethnicity.csv and labour.csv (geo)")
    ap.add_argument("--sentiment", help="business sentiment table (train, recommend)")
    ap.add_argument("--model", help="saved model (recommend)")
    ap.add_argument("--city", default=CITY, help="city of the star map (profile) and of the texts (text)")
    ap.add_argument("--city-like", default=CITY_LIKE, help="LIKE pattern of the city (geo)")
    ap.add_argument("--category-like", default=CATEGORY_LIKE, help="LIKE pattern of the categories (geo)")
    ap.add_argument("--groups", nargs="+", default=GROUPS, help="population columns (geo)")
    ap.add_argument("--provinces", nargs="+", default=PROVINCES, help="provinces of the cuisine rankings (profile)")
    ap.add_argument("--cuisines", nargs="+", default=CUISINES, help="category names without blanks (profile)")
    ap.add_argument("--attr-main", default=ATTR_MAIN, help="attribute counted by value (profile)")
    ap.add_argument("--attr-subset", default=ATTR_SUBSET, help="nested attribute counted by sub-key (profile)")
    ap.add_argument("--k", type=int, default=TOP_K, help="length of rankings (profile), suggestions a user (recommend)")
    ap.add_argument("--threshold", type=float, default=THRESHOLD, help="stars that part the two segments (text)")
    ap.add_argument("--topics", type=int, default=PR.LDA_K, help="topics a segment (text)")
    ap.add_argument("--users", type=int, default=N_USERS, help="users to suggest to (recommend)")
    ap.add_argument("--date", help="day of the supposed reviews, yyyy-MM-dd; default today (recommend)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"revlens-{a.job}").getOrCreate()
    if a.job == "etl":
        etl(spark, a.input, a.out)
    elif a.job == "profile":
        profile(spark, a.input, a.out, a.provinces, a.city, a.cuisines, a.k, a.attr_main, a.attr_subset)
    elif a.job == "geo":
        geo(spark, a.input, a.lookup, a.out, a.city_like, a.category_like, a.groups)
    elif a.job == "text":
        text(spark, a.input, a.out, a.city, a.threshold, a.topics)
    elif a.job == "train":
        print(train(spark, a.input, a.sentiment, a.out))
    else:
        recommend(spark, a.input, a.sentiment, a.model, a.out, a.users, a.date, a.k)


if __name__ == "__main__":
    main()
