"""One naming contract for every table (raw JSON in, clean tables out).

Raw inputs keep the lower-case JSON keys of the public review dataset. Every
clean table produced by :mod:`revlens.operators.prepare` and read by the
analyses uses the CamelCase names below, so ETL output feeds analysis input
without renaming.
"""

from pyspark.sql import types as T

# ---- raw inputs (JSON lines) ------------------------------------------------
# The field names below are those of the input JSON records and
# must be spelled as the files spell them.

PROVINCE_RAW = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("province", T.StringType()),
])

COMPLIMENTS = ["compliment_writer", "compliment_profile", "compliment_plain",
               "compliment_photos", "compliment_note", "compliment_more",
               "compliment_list", "compliment_hot", "compliment_funny",
               "compliment_cute", "compliment_cool"]


def business_raw(attribute_fields: list[str]) -> T.StructType:
    """Business JSON; the attribute struct's fields vary by data release."""
    attrs = T.StructType([T.StructField(f, T.StringType()) for f in attribute_fields])
    return T.StructType([
        T.StructField("business_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("is_open", T.LongType()),
        T.StructField("categories", T.StringType()),
        T.StructField("attributes", attrs),
    ])


CHECKIN_RAW = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("date", T.StringType()),
])

REVIEW_RAW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("cool", T.LongType()),
    T.StructField("funny", T.LongType()),
    T.StructField("useful", T.LongType()),
])

USER_RAW = T.StructType(
    [T.StructField("user_id", T.StringType()), T.StructField("name", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in COMPLIMENTS]
    + [T.StructField("useful", T.LongType()), T.StructField("funny", T.LongType()),
       T.StructField("cool", T.LongType()), T.StructField("friends", T.StringType()),
       T.StructField("fans", T.LongType()), T.StructField("elite", T.StringType()),
       T.StructField("review_count", T.LongType()),
       T.StructField("average_stars", T.DoubleType()),
       T.StructField("yelping_since", T.StringType())])

# ---- clean tables -------------------------------------------------------------

BUSINESS_COLS = ["BusinessID", "Name", "State", "City", "PostalCode", "Latitude",
                 "Longitude", "Categories", "BusinessStars", "ReviewCount"]
CATEGORY_COLS = ["BusinessID", "Category", "Served"]
ATTRIBUTE_COLS = ["BusinessID", "attr_key", "attr_val"]
CHECKIN_COLS = ["BusinessID", "CheckinDate"]
REVIEW_COLS = ["ReviewID", "BusinessID", "UserID", "Review", "Date", "ReviewStars",
               "Cool", "Funny", "Useful"]
USER_COLS = (["UserID", "UserName"]
             + ["Compliment" + c.split("_")[1].capitalize() for c in COMPLIMENTS]
             + ["Useful", "Funny", "Cool", "Fans", "ReviewCount", "AverageStars",
                "MemberSince"])
FRIEND_COLS = ["UserID", "FriendUserID"]
ELITE_COLS = ["UserID", "EliteYear"]

# Lookup tables arrive as CSV with header and are all strings; numbers are
# parsed by the operators with try_cast.
POSTCODE_COLS = ["Postcode", "Borough", "Neighbourhood"]
LABOUR_COLS = ["Neighbourhood", "NeighbourhoodId", "CombinedIndicators", "TotalPopulation",
               "LabourForceCategory", "InLabourForce", "Unemployed"]
PLACEHOLDER = "Not assigned"
