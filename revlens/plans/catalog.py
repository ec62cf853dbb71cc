"""Registered queries: each key binds an operator to the stand-in views.

``QUERIES[key](spark, sf_dir)`` returns a DataFrame; ``ORACLE[key]`` is the
DuckDB SQL computing the same rows on the same parquet tables. Keys without
an oracle entry (ML fits) are checked by row count and by pytest properties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators import geo as G
from revlens.operators import prepare as P
from revlens.operators import profile as Q
from revlens.operators import recommend as R
from revlens.operators import sentiment as S
from revlens.operators import text as T
from revlens.operators import topics as L
from revlens.operators.joins import broadcast_if_small
from revlens.operators.merged import merged_text
from revlens.operators.suggest import top_for_all
from revlens.plans import oracle as O
from revlens.plans import params as PR
from revlens.plans import views as V
from revlens.schemas import REVIEW_RAW
from revlens.sources.io import load_model, parse_records, persist_cut, save_model, stored, write_staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = O.build(sql)
        return fn
    return deco


# ---- pipeline pieces shared by many keys ---------------------------------------

def business(spark, d):
    return P.business_clean(V.business_raw(spark, d), V.provinces(spark, d))


def categories(spark, d):
    return P.category_rows(business(spark, d))


def attributes(spark, d):
    return P.attribute_rows(business(spark, d))


def checkins(spark, d):
    return P.checkin_explode(V.checkin_raw(spark, d), business(spark, d))


def reviews(spark, d):
    return P.review_clean(V.review_raw(spark, d), business(spark, d))


def users(spark, d):
    return P.user_valid(V.user_raw(spark, d), reviews(spark, d))


_BIZ_COLS = "BusinessID, Name, State, City, PostalCode, Latitude, Longitude, Categories, BusinessStars, ReviewCount"
_SANITIZE = "regexp_replace({c}, '[^0-9a-zA-Z$]+', '', 'g')"
# The names found in the test tables. The Spark side takes them
# from the data; the SQL needs them listed.
_CATEGORIES = ["ANVIL", "BLUE", "BOLT", "COLD", "FOODCOURT", "GEAR", "GIZMO", "HOT", "LARGE", "NEW", "OLD", "PLATE",
               "RED", "RING", "ROD", "SMALL", "WIDGET"]
_ATTRIBUTES = ["Ambienceblue", "Ambiencecasual", "Ambiencecold", "Ambiencehot", "Ambiencelarge", "Ambiencenew",
               "Ambienceold", "Ambiencered", "Ambienceromantic", "Ambiencesmall", "BikeParking", "GoodForMeal",
               "GoodForMealdessert", "GoodForMealdinner", "GoodForMeallunch", "RestaurantsPriceRange2", "WiFi"]


def _in(prefix: str, names: list[str]) -> str:
    return "(" + ", ".join(f"'{prefix}{n}'" for n in names) + ")"


_CAT_WIDE = ("PIVOT (SELECT BusinessID, 'CAT_' || " + _SANITIZE.format(c="Category")
             + f" AS k, Served FROM category_rows) ON k IN {_in('CAT_', _CATEGORIES)} USING max(Served) "
             "GROUP BY BusinessID")
_ATTR_WIDE = ("PIVOT (SELECT BusinessID, 'ATTR_' || " + _SANITIZE.format(c="attr_key")
              + f" AS k, attr_val FROM attribute_rows) ON k IN {_in('ATTR_', _ATTRIBUTES)} USING max(attr_val) "
              "GROUP BY BusinessID")

# ---- ETL ---------------------------------------------------------------------


@register("etl_business_clean", f"SELECT {_BIZ_COLS} FROM business_clean")
def q_etl_business_clean(spark, d):
    # The attribute struct is compared through etl_attribute_rows.
    return business(spark, d).drop("Attributes")


@register("etl_category_rows", "SELECT BusinessID, Category, Served FROM category_rows")
def q_etl_category_rows(spark, d):
    return categories(spark, d)


@register("etl_category_wide", f"SELECT * FROM ({_CAT_WIDE})")
def q_etl_category_wide(spark, d):
    return P.category_wide(categories(spark, d))


@register("etl_attribute_rows", "SELECT BusinessID, attr_key, attr_val FROM attribute_rows")
def q_etl_attribute_rows(spark, d):
    return attributes(spark, d)


@register("etl_attribute_wide", f"SELECT * FROM ({_ATTR_WIDE})")
def q_etl_attribute_wide(spark, d):
    return P.attribute_wide(attributes(spark, d))


@register("etl_business_wide",
          "SELECT * FROM (SELECT BusinessID, Name, State, City, PostalCode, Latitude, Longitude, "
          "BusinessStars, ReviewCount FROM business_clean) b "
          f"JOIN ({_CAT_WIDE}) c USING (BusinessID) JOIN ({_ATTR_WIDE}) a USING (BusinessID)")
def q_etl_business_wide(spark, d):
    b = business(spark, d)
    cw = P.category_wide(P.category_rows(b))
    aw = P.attribute_wide(P.attribute_rows(b))
    return P.business_wide(b, cw, aw)


@register("etl_checkin_explode", "SELECT BusinessID, CheckinDate FROM checkins")
def q_etl_checkin_explode(spark, d):
    return checkins(spark, d)


@register("etl_review_clean", "SELECT * FROM reviews")
def q_etl_review_clean(spark, d):
    return reviews(spark, d)


@register("etl_review_quarantine", """
  SELECT reason, count(*) AS records FROM (
    SELECT CASE WHEN o % 101 = 0 THEN 'not JSON' WHEN o % 103 = 0 AND stars IS NOT NULL THEN 'wrong type' ELSE 'good' END AS reason
    FROM (SELECT CAST(split_part(review_id, '-', 1) AS BIGINT) AS o, stars FROM review_raw))
  GROUP BY reason""")
def q_etl_review_quarantine(spark, d):
    """Review lines by what becomes of them: all are parsed, none is lost."""
    return P.record_reasons(parse_records(V.review_lines(spark, d), REVIEW_RAW))


@register("etl_user_valid", "SELECT * FROM users")
def q_etl_user_valid(spark, d):
    return users(spark, d)


@register("etl_user_friends", "SELECT UserID, FriendUserID FROM user_friends")
def q_etl_user_friends(spark, d):
    return P.user_friends(V.user_raw(spark, d), reviews(spark, d))


@register("etl_user_elites", "SELECT UserID, EliteYear FROM user_elites")
def q_etl_user_elites(spark, d):
    return P.user_elites(V.user_raw(spark, d), reviews(spark, d))


@register("ref_postcode_filter", "SELECT Postcode, Borough, Neighbourhood FROM postcodes_ok")
def q_ref_postcode_filter(spark, d):
    return P.postcode_filter(V.postcodes(spark, d))


# ---- business profiles ----------------------------------------------------------

_CUISINE_LIST = ", ".join(f"'{c}'" for c in PR.CUISINES)


@register("biz_top_cuisines", f"""
  SELECT Categories, State, count(BusinessID) AS BusinessCount FROM (
    SELECT BusinessID, State, replace(c, ' ', '') AS Categories FROM (
      SELECT BusinessID, State, unnest(string_split(Categories, ',')) AS c
      FROM business_clean WHERE State = '{PR.PROVINCE}'))
  WHERE Categories IN ({_CUISINE_LIST})
  GROUP BY Categories, State ORDER BY BusinessCount DESC, Categories LIMIT {PR.TOP_K}""")
def q_biz_top_cuisines(spark, d):
    return Q.top_cuisines(business(spark, d), PR.PROVINCE, PR.CUISINES, PR.TOP_K)


@register("biz_city_star_map", f"""
  SELECT BusinessID, Name, replace(PostalCode, ' ', '') AS ZipCode, Latitude, Longitude,
         CAST(floor(BusinessStars) AS BIGINT) AS Stars
  FROM business_clean WHERE City = '{PR.CITY}'""")
def q_biz_city_star_map(spark, d):
    return Q.city_star_map(business(spark, d), PR.CITY)


@register("biz_top_categories", f"""
  SELECT Category, count(BusinessID) AS CategoryCount FROM category_rows
  GROUP BY Category ORDER BY CategoryCount DESC, Category LIMIT {PR.TOP_K}""")
def q_biz_top_categories(spark, d):
    return Q.top_categories(categories(spark, d), PR.TOP_K)


@register("biz_city_counts", """
  SELECT State, City, count(BusinessID) AS BusinessCount FROM business_clean GROUP BY State, City""")
def q_biz_city_counts(spark, d):
    return Q.city_counts(business(spark, d))


@register("biz_province_avg_stars", """
  SELECT State, round(avg(BusinessStars), 6) AS AverageStar FROM business_clean GROUP BY State""")
def q_biz_province_avg_stars(spark, d):
    return Q.province_avg_stars(business(spark, d))


@register("biz_attr_main_dist", f"""
  SELECT attr_val AS {PR.ATTR_MAIN_KEY}, count(BusinessID) AS BusinessCount FROM attribute_rows
  WHERE contains(attr_key, '{PR.ATTR_MAIN_KEY}') GROUP BY attr_val""")
def q_biz_attr_main_dist(spark, d):
    return Q.attr_main_dist(attributes(spark, d), PR.ATTR_MAIN_KEY)


@register("biz_attr_subset_dist", f"""
  SELECT v AS {PR.ATTR_SUBSET_KEY}, count(BusinessID) AS Count FROM (
    SELECT BusinessID, string_split(attr_key, '_')[2] AS v FROM attribute_rows
    WHERE contains(attr_key, '{PR.ATTR_SUBSET_KEY}') AND upper(attr_val) = 'TRUE')
  GROUP BY v""")
def q_biz_attr_subset_dist(spark, d):
    return Q.attr_subset_dist(attributes(spark, d), PR.ATTR_SUBSET_KEY)


# ---- check-in profiles -----------------------------------------------------------

@register("chk_heatmap", """
  SELECT CAST(isodow(CheckinDate) AS INTEGER) AS CheckinWeekDayNo,
         strftime(CheckinDate, '%a') AS CheckinWeekDayName,
         strftime(CheckinDate, '%H') AS CheckinHour, count(BusinessID) AS CheckinCount
  FROM checkins GROUP BY ALL""")
def q_chk_heatmap(spark, d):
    return Q.checkin_heatmap(checkins(spark, d))


@register("chk_months", """
  SELECT strftime(CheckinDate, '%m') AS MonthNo, strftime(CheckinDate, '%b') AS MonthName,
         count(BusinessID) AS CheckinCount FROM checkins GROUP BY ALL""")
def q_chk_months(spark, d):
    return Q.checkin_months(checkins(spark, d))


@register("chk_days", """
  SELECT CAST(isodow(CheckinDate) AS INTEGER) AS DayNo, strftime(CheckinDate, '%a') AS DayName,
         count(BusinessID) AS CheckinCount FROM checkins GROUP BY ALL""")
def q_chk_days(spark, d):
    return Q.checkin_days(checkins(spark, d))


@register("chk_hours", """
  SELECT strftime(CheckinDate, '%H') AS Hour, count(BusinessID) AS CheckinCount
  FROM checkins GROUP BY ALL""")
def q_chk_hours(spark, d):
    return Q.checkin_hours(checkins(spark, d))


# ---- review and user profiles -------------------------------------------------------

@register("rev_years", """
  SELECT CAST(year(Date) AS INTEGER) AS Year, count(BusinessID) AS ReviewCount
  FROM reviews GROUP BY ALL""")
def q_rev_years(spark, d):
    return Q.review_years(reviews(spark, d))


@register("rev_star_trend", """
  SELECT ReviewStars, Date, count(ReviewStars) AS Count FROM reviews GROUP BY ReviewStars, Date""")
def q_rev_star_trend(spark, d):
    return Q.review_star_trend(reviews(spark, d))


@register("usr_join_years", """
  SELECT CAST(year(MemberSince) AS INTEGER) AS Year, count(UserID) AS UsersCount
  FROM users GROUP BY ALL""")
def q_usr_join_years(spark, d):
    return Q.user_join_years(users(spark, d))


@register("usr_review_buckets", f"""
  SELECT concat(CAST(s AS VARCHAR), '-', CAST(s + {PR.BUCKET_WIDTH - 1} AS VARCHAR)) AS ReviewNo,
         count(UserID) AS UserCount
  FROM (SELECT UserID, CAST(floor(ReviewCount / {PR.BUCKET_WIDTH}) AS BIGINT) * {PR.BUCKET_WIDTH} AS s
        FROM users)
  GROUP BY s""")
def q_usr_review_buckets(spark, d):
    return Q.user_review_buckets(users(spark, d), PR.BUCKET_WIDTH)


@register("usr_star_floor", """
  SELECT CAST(floor(AverageStars) AS BIGINT) AS Stars, count(UserID) AS UsersCount
  FROM users GROUP BY ALL""")
def q_usr_star_floor(spark, d):
    return Q.user_star_floor(users(spark, d))


# ---- geo ---------------------------------------------------------------------

_G = PR.GROUP_COLUMNS
_BIZ_SIDE = O.BIZ_SIDE
def postcodes_ok(spark, d):
    return P.postcode_filter(V.postcodes(spark, d))


@register("geo_group_share", f"""
  SELECT b.BusinessID, b.Name, b.Latitude, b.Longitude, b.BusinessStars, s.Neighbourhood,
         {", ".join("s." + g for g in _G)}
  FROM business_clean b LEFT JOIN geo_shares s ON split_part(b.PostalCode, ' ', 1) = s.PostCode
  WHERE b.City LIKE '{PR.CITY_LIKE}' AND b.Categories LIKE '{PR.CATEGORY_LIKE}'""")
def q_geo_group_share(spark, d):
    return G.group_share(business(spark, d), postcodes_ok(spark, d), V.ethnicity(spark, d),
                         PR.CITY_LIKE, PR.CATEGORY_LIKE, _G)


@register("geo_labour_ratio", f"""
  SELECT Neighbourhood, round(avg(BusinessStars), 6) AS BusinessStars,
         round(avg(CAST(InLabourForce AS DOUBLE) / NULLIF(CAST(LabourForceCategory AS DOUBLE), 0)), 6) AS ratio_emply
  FROM (SELECT b.BusinessStars, l.* FROM business_clean b
        LEFT JOIN geo_labour l ON split_part(b.PostalCode, ' ', 1) = l.PostCode
        WHERE b.City LIKE '{PR.CITY_LIKE}')
  WHERE Neighbourhood IS NOT NULL AND NeighbourhoodId IS NOT NULL AND LabourForceCategory IS NOT NULL
    AND InLabourForce IS NOT NULL AND Unemployed IS NOT NULL AND PostCode IS NOT NULL
  GROUP BY Neighbourhood""")
def q_geo_labour_ratio(spark, d):
    return G.labour_ratio(business(spark, d), postcodes_ok(spark, d), V.labour(spark, d), PR.CITY_LIKE)


# ---- text --------------------------------------------------------------------

def text_clean(spark, d):
    return T.clean_reviews(V.text_reviews(spark, d), V.text_businesses(spark, d), PR.TEXT_CITY)


def text_scores(spark, d):
    return S.sentiment(text_clean(spark, d).drop("clean_text"), "text_ascii")


def rated_lexicon(spark, d):
    """Words and valences learnt from the city's rated reviews."""
    stars = V.text_reviews(spark, d).select("ReviewID", "ReviewStars", "Review", "BusinessID")
    city = T.city_businesses(V.text_businesses(spark, d), PR.TEXT_CITY).select("BusinessID")
    return S.rated_lexicon(stars.join(broadcast_if_small(city), "BusinessID", "left_semi"), "Review", "ReviewStars",
                           PR.RATING_THRESHOLD, PR.LEXICON_LEAST)


def text_merged(spark, d):
    return T.merge_reviews(V.text_reviews(spark, d), V.text_businesses(spark, d), PR.TEXT_CITY)


@register("txt_clean", "SELECT ReviewID, BusinessID, Name, text_ascii, clean_text FROM text_clean")
def q_txt_clean(spark, d):
    return text_clean(spark, d)


@register("txt_tokens", f"""
  SELECT ReviewID, BusinessID, Name, CAST(len(t) AS INTEGER) AS token_count, array_to_string(t, ' ') AS fine_text
  FROM (SELECT *, list_filter(regexp_extract_all(lower(clean_text), '\\w+'), lambda x: x NOT IN {O.STOP_WORDS}) AS t
        FROM text_clean)""")
def q_txt_tokens(spark, d):
    # The token array is compared as its blank-joined text and its length.
    return T.review_tokens(text_clean(spark, d)).withColumn("token_count", F.size("no_stopword")).drop("no_stopword")


@register("txt_sentiment_review", "SELECT * FROM text_sentiment")
def q_txt_sentiment_review(spark, d):
    return text_scores(spark, d)


@register("txt_lexicon_rated", "SELECT token, valence, high, low FROM lexicon_rated")
def q_txt_lexicon_rated(spark, d):
    return rated_lexicon(spark, d)


@register("txt_sentiment_rated", "SELECT * FROM text_sentiment_rated")
def q_txt_sentiment_rated(spark, d):
    """Sentiment by the learnt lexicon, whose size grows with the reviews."""
    return S.sentiment(text_clean(spark, d).drop("clean_text"), "text_ascii", rated_lexicon(spark, d))


@register("txt_sentiment_business", f"""
  SELECT g.BusinessID, avg_neg, avg_neu, avg_pos, avg_composite_score, b.Name,
         replace(b.PostalCode, ' ', '') AS ZipCode, b.Latitude, b.Longitude
  FROM (SELECT BusinessID, round(avg(Negative), 2) AS avg_neg, round(avg(Neutral), 2) AS avg_neu,
               round(avg(Positive), 2) AS avg_pos, round(avg(Compound), 2) AS avg_composite_score
        FROM text_sentiment GROUP BY BusinessID) g
  JOIN text_businesses b ON g.BusinessID = b.BusinessID WHERE b.City = '{PR.TEXT_CITY}'""")
def q_txt_sentiment_business(spark, d):
    return T.business_sentiment(text_scores(spark, d), V.text_businesses(spark, d), PR.TEXT_CITY)


@register("txt_merge_reviews", "SELECT BusinessID, Review, BusinessName, BusinessStars FROM merged_reviews")
def q_txt_merge_reviews(spark, d):
    return text_merged(spark, d)


@register("txt_merged_text", f"""
  SELECT BusinessID, CAST(before + i AS BIGINT) AS chunk, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5
  FROM (SELECT BusinessID, before, i, substr(whole, CAST(i * {PR.CHUNK_CHARS} + 1 AS BIGINT), {PR.CHUNK_CHARS}) AS t
        FROM (SELECT *, unnest(range(pieces)) AS i FROM (
          SELECT *, coalesce(sum(pieces) OVER (PARTITION BY BusinessID ORDER BY part
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM (SELECT *, CAST(ceil(length(whole) / {PR.CHUNK_CHARS}) AS BIGINT) AS pieces FROM (
            SELECT BusinessID, part, CASE WHEN row_number() OVER (PARTITION BY BusinessID ORDER BY part) = 1 THEN '' ELSE ' ' END
                   || joined AS whole FROM merged_parts)))))""")
def q_txt_merged_text(spark, d):
    """Chunks of each business's one text, as digests."""
    t = merged_text(text_merged(spark, d), PR.CHUNK_CHARS)
    return t.select("BusinessID", "chunk", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


@register("txt_tfidf", """
  SELECT BusinessID, term, tf, round(idf, 9) AS idf, round(tf * idf, 9) AS tfidf
  FROM term_freqs JOIN term_idfs USING (term)""")
def q_txt_tfidf(spark, d):
    t = T.tfidf_table(text_merged(spark, d))
    return t.withColumns({c: F.round(c, 9) for c in ("idf", "tfidf")})  # two libraries' logarithms


def _paths(d: str, *tables: str) -> list[str]:
    return [f"{d}/{t}.parquet" for t in tables]


def _topic_model(spark, d):
    """The topic model of a table folder: read where one was fitted on these very
    files with these parameters, else fitted and stored."""
    path, there = stored(spark, "topics", _paths(d, "documents", "labels"), PR.TEXT_CITY, PR.RATING_THRESHOLD,
                         PR.LDA_K, PR.LDA_SEED)
    if not there:
        terms = T.segment_terms(persist_cut(text_merged(spark, d), spark, "topic-merged"), PR.RATING_THRESHOLD)
        write_staged(L.fit_topics(terms, PR.LDA_K, PR.LDA_SEED)[0], path)
    return spark.read.schema(L.columns(PR.LDA_K)).parquet(path)


def _topic_distribution(spark, d):
    """Mixtures of all documents, inferred under the stored model."""
    model = _topic_model(spark, d)
    merged = persist_cut(text_merged(spark, d), spark, "topic-merged")
    return T.topic_distribution(model, T.segment_terms(merged, PR.RATING_THRESHOLD),
                                T.segment_documents(merged, PR.RATING_THRESHOLD))


@register("txt_topic_words")
def q_txt_topic_words(spark, d):
    return T.topic_words(_topic_model(spark, d))


@register("txt_topic_dist")
def q_txt_topic_dist(spark, d):
    return _topic_distribution(spark, d)


@register("txt_topic_rows")
def q_txt_topic_rows(spark, d):
    return T.topic_rows(_topic_distribution(spark, d))


# ---- recommender ---------------------------------------------------------------

def rec_inputs(spark, d):
    """Reviews, users and business sentiment; the reviews, from which the other
    two are derived, are written once."""
    b = persist_cut(business(spark, d), spark, "rec-business")
    r = persist_cut(P.review_clean(V.review_raw(spark, d), b).drop("Review"), spark, "rec-reviews")
    return r, P.user_valid(V.user_raw(spark, d), r), V.rec_sentiment(r, b)


def rec_features(spark, d):
    r, u, s = rec_inputs(spark, d)
    return R.features(r, u, s)


def rec_candidates(spark, d):
    r, u, s = rec_inputs(spark, d)
    return R.candidates(u, r, s, PR.N_USERS, PR.AS_OF_DATE)


@register("rec_features", f"""
  SELECT r.BusinessID, r.UserID, u.UserName, u.ReviewCount AS UserReviewCount,
         u.AverageStars AS UserAverageStars, r.ReviewStars,
         CAST(dayofyear(r.Date) AS INTEGER) AS ReviewDayOfYear, {_BIZ_SIDE}
  FROM reviews r JOIN users u ON r.UserID = u.UserID
  JOIN rec_sentiment s ON r.BusinessID = s.BusinessID WHERE s.ZipCode IS NOT NULL""")
def q_rec_features(spark, d):
    return rec_features(spark, d)


def _model_path(spark, d):
    return stored(spark, "recommender", _paths(d, "part", "orders", "lineitem", "customer"), PR.SPLIT_SEED)


def _train(spark, d) -> dict[str, float]:
    """Fit, evaluate and store the model."""
    model, metrics = R.train_eval(rec_features(spark, d), PR.SPLIT_SEED)
    save_model(model, _model_path(spark, d)[0])
    return metrics


@register("rec_train_eval")
def q_rec_train_eval(spark, d):
    m = _train(spark, d)
    return spark.createDataFrame([(float(m["r2"]), float(m["rmse"]))], "r2 double, rmse double")


@register("rec_eval_fixed", f"""
  SELECT train, n, round(1 - sse / (ss - sum_y * sum_y / n), 9) AS r2, round(sqrt(sse / n), 9) AS rmse FROM (
    SELECT train, count(*) AS n, sum((y - p) * (y - p)) AS sse, sum(y) AS sum_y, sum(y * y) AS ss FROM (
      SELECT CAST('0x' || substr(md5(concat_ws('|', '{PR.SPLIT_SEED}', r.BusinessID, r.UserID,
                    CAST(dayofyear(r.Date) AS VARCHAR), CAST(CAST(r.ReviewStars AS INTEGER) AS VARCHAR))), 1, 8) AS BIGINT)
               % 10000 < 7500 AS train,
             CAST(r.ReviewStars AS DOUBLE) AS y, u.AverageStars + 3.0::DOUBLE * (s.avg_pos - s.avg_neg) AS p
      FROM reviews r JOIN users u ON r.UserID = u.UserID
      JOIN rec_sentiment s ON r.BusinessID = s.BusinessID WHERE s.ZipCode IS NOT NULL)
    WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY train)""")
def q_rec_eval_fixed(spark, d):
    """Size, r2 and rmse of the fixed score on both sides of the split."""
    rows = R.fixed_score(persist_cut(rec_features(spark, d), spark, "rec-rows"))
    rows = rows.withColumn("train", R.split_side(rows, PR.SPLIT_SEED))
    sides = [R.regression_metrics(rows.where(F.col("train") == side), prediction="PredictedReviewStar").select(
        F.lit(side).alias("train"), "n", F.round("r2", 9).alias("r2"), F.round("rmse", 9).alias("rmse"))
        for side in (True, False)]
    return sides[0].unionByName(sides[1])


@register("rec_candidates", "SELECT * FROM rec_cand")
def q_rec_candidates(spark, d):
    return rec_candidates(spark, d)


@register("rec_top10", f"""
  SELECT * FROM (
    SELECT BusinessID, BusinessName, BusinessPostalCode, BusinessNeighborhood, UserID, UserName,
           UserReviewCount, UserAverageStars, ReviewDayOfYear, PredictedReviewStar, Latitude, Longitude,
           AverageNegative, AverageNeutral, AveragePositive, AverageComposite, FinalStar,
           CAST(row_number() OVER (PARTITION BY UserID ORDER BY FinalStar DESC, BusinessID) AS INTEGER) AS "rank"
    FROM (SELECT *, least(greatest(PredictedReviewStar, CAST(0.0 AS DOUBLE)), CAST(5.0 AS DOUBLE)) AS FinalStar
          FROM (SELECT *, UserAverageStars + CAST(3.0 AS DOUBLE) * (AveragePositive - AverageNegative)
                       AS PredictedReviewStar FROM rec_cand)))
  WHERE "rank" <= {PR.TOP_N}""")
def q_rec_top10(spark, d):
    return R.top_n(R.fixed_score(rec_candidates(spark, d)), PR.TOP_N)


@register("rec_top10_model")
def q_rec_top10_model(spark, d):
    """Top 10 by the model stored for these very files (trained where none is)."""
    path, there = _model_path(spark, d)
    if not there:
        _train(spark, d)
    return R.top_n(R.predict(load_model(path), rec_candidates(spark, d)), PR.TOP_N)


@register("rec_top10_all", f"""
  SELECT UserID, BusinessID, FinalStar, "rank" FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY UserID ORDER BY FinalStar DESC, BusinessID) AS INTEGER) AS "rank"
    FROM (SELECT u.UserID, s.BusinessID,
                 least(greatest(u.AverageStars + 3.0::DOUBLE * (s.avg_pos - s.avg_neg), 0.0::DOUBLE), 5.0::DOUBLE) AS FinalStar
          FROM users u CROSS JOIN rec_sentiment s
          WHERE s.ZipCode IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM reviews r WHERE r.BusinessID = s.BusinessID AND r.UserID = u.UserID)))
  WHERE "rank" <= {PR.TOP_N}""")
def q_rec_top10_all(spark, d):
    """The ten best businesses by the fixed score for every user."""
    r, u, s = rec_inputs(spark, d)
    users = persist_cut(u.select("UserID", F.col("AverageStars").cast("double").alias("value")), spark, "rec-users")
    lean = F.lit(3.0) * (F.col("avg_pos") - F.col("avg_neg"))
    biz = persist_cut(s.where("ZipCode IS NOT NULL").select("BusinessID", lean.alias("value")), spark, "rec-lean")
    return top_for_all(users, r, biz, PR.TOP_N)[0]
