"""Raw records to clean tables (the ETL layer).

Validity is a filter, so every "restrict to valid X" step is a semi join on
X's key: a row is never repeated once per match, and the right side is
reduced to its distinct keys before the shuffle, so a hot key on the right
cannot pile up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import schemas
from revlens.functions import attributes as A
from revlens.functions import dates as D
from revlens.functions import text as X

# Most columns of a pivot (Spark's own ceiling, spark.sql.pivotMaxValues); more
# names become one map column.
PIVOT_MAX_VALUES = 10_000


def business_clean(business_raw: DataFrame, provinces: DataFrame,
                   postcode_length: int = 7) -> DataFrame:
    """Open businesses of the listed provinces with complete core fields."""
    prov = provinces.select(F.col("code").alias("state"))
    b = business_raw.where(
        (F.col("is_open") == 1)
        & F.col("postal_code").isNotNull()
        & (F.length("postal_code") == postcode_length)
        & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        & F.col("stars").isNotNull() & F.col("review_count").isNotNull()
        & F.col("categories").isNotNull() & F.col("attributes").isNotNull())
    b = b.join(prov, "state", "left_semi")
    return b.select(
        F.col("business_id").alias("BusinessID"), F.col("name").alias("Name"),
        F.col("state").alias("State"), F.col("city").alias("City"),
        F.col("postal_code").alias("PostalCode"), F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"), F.col("categories").alias("Categories"),
        F.col("attributes").alias("Attributes"), F.col("stars").alias("BusinessStars"),
        F.col("review_count").alias("ReviewCount"))


def category_rows(business: DataFrame) -> DataFrame:
    """One upper-case, trimmed row per business and listed category; an empty
    name between two commas is a row too."""
    e = business.select("BusinessID", F.explode(F.split("Categories", ",")).alias("c"))
    return e.select("BusinessID", F.upper(F.trim("c")).alias("Category"), F.lit(True).alias("Served"))


def pivot_values(df: DataFrame, col: str, max_values: int = PIVOT_MAX_VALUES) -> list[str] | None:
    """Sorted distinct values of ``col``, the column set of a pivot; None if there
    are more than ``max_values``. Computed once (a distinct with map-side combine),
    instead of letting ``pivot`` run its own extra job."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_values + 1).collect()
    return sorted(r[0] for r in rows) if len(rows) <= max_values else None


def _pivot_wide(rows: DataFrame, key: str, value: str, agg, prefix: str,
                values: list[str] | None, max_values: int) -> DataFrame:
    k = rows.select("BusinessID", X.sanitize_name(F.col(key)).alias("_k"), value)
    if values is None:
        values = pivot_values(k, "_k", max_values)
    if values is None:
        return _as_map(k, value, agg, prefix.rstrip("_"))
    w = k.groupBy("BusinessID").pivot("_k", values).agg(agg(value))
    return w.select("BusinessID", *[F.col(f"`{v}`").alias(prefix + v) for v in values])


def _as_map(rows: DataFrame, value: str, agg, name: str) -> DataFrame:
    """One row per business with a map from each of its own names to the aggregated
    value: the pivot of any number of names, without the cells of other businesses'
    names. A business's names are as many as its own rows."""
    each = rows.groupBy("BusinessID", "_k").agg(agg(value).alias("_v"))
    entry = F.when(F.col("_k").isNotNull(), F.struct("_k", "_v"))  # collect_list leaves nulls out
    return each.groupBy("BusinessID").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name))


def category_wide(cat_rows: DataFrame, values: list[str] | None = None,
                  max_values: int = PIVOT_MAX_VALUES) -> DataFrame:
    """Boolean CAT_<name> column per category; names are sanitised before the
    pivot so two raw spellings of one name fall into one column. Of more than
    ``max_values`` names, one column CAT: a map from each of the business's names."""
    return _pivot_wide(cat_rows, "Category", "Served", F.max, "CAT_", values, max_values)


def attribute_rows(business: DataFrame, struct_col: str = "Attributes") -> DataFrame:
    """One row per business and flattened attribute entry (see functions.attributes)."""
    e = business.select("BusinessID", F.explode(A.attribute_entries(business, struct_col)).alias("e"))
    return e.select("BusinessID", F.col("e.key").alias("attr_key"), F.col("e.val").alias("attr_val"))


def attribute_wide(attr_rows: DataFrame, values: list[str] | None = None,
                   max_values: int = PIVOT_MAX_VALUES) -> DataFrame:
    """ATTR_<key> column per attribute; of more than ``max_values`` keys, one map
    column ATTR (see :func:`category_wide`)."""
    return _pivot_wide(attr_rows, "attr_key", "attr_val", F.max, "ATTR_", values, max_values)


def business_wide(business: DataFrame, cat_wide: DataFrame, attr_wide: DataFrame) -> DataFrame:
    """Business row with its CAT_* and ATTR_* columns. All three inputs are
    unique on BusinessID, so both joins share one hash partitioning."""
    base = business.drop("Categories", "Attributes")
    return base.join(cat_wide, "BusinessID").join(attr_wide, "BusinessID")


def checkin_explode(checkin_raw: DataFrame, business: DataFrame) -> DataFrame:
    """One row per check-in time of a valid business. Empty pieces are
    dropped; a piece that is not a time gives a null time."""
    c = checkin_raw.select(F.col("business_id").alias("BusinessID"), "date")
    c = c.join(business.select("BusinessID"), "BusinessID", "left_semi")
    e = c.select("BusinessID", F.explode(F.split("date", ",")).alias("t"))
    return e.where(F.col("t") != "").select("BusinessID", D.parse_time(F.trim("t")).alias("CheckinDate"))


def record_reasons(parsed: DataFrame) -> DataFrame:
    """Number of records by reason (see sources.io.parse_records), ``good`` for none."""
    return parsed.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("records"))


def review_clean(review_raw: DataFrame, business: DataFrame) -> DataFrame:
    """Reviews of valid businesses with text, votes and stars in [0, 5]."""
    r = review_raw.where(
        F.col("text").isNotNull() & F.col("useful").isNotNull() & F.col("cool").isNotNull()
        & F.col("funny").isNotNull() & F.col("stars").isNotNull()
        & F.col("stars").between(0, 5))
    r = r.join(business.select(F.col("BusinessID").alias("business_id")), "business_id", "left_semi")
    return r.select(
        F.col("review_id").alias("ReviewID"), F.col("business_id").alias("BusinessID"),
        F.col("user_id").alias("UserID"),
        F.regexp_replace("text", "\n", " ").alias("Review"),
        F.expr("try_cast(date AS DATE)").alias("Date"),
        F.col("stars").alias("ReviewStars"), F.col("cool").alias("Cool"),
        F.col("funny").alias("Funny"), F.col("useful").alias("Useful"))


def users_with_reviews(user_raw: DataFrame, reviews: DataFrame) -> DataFrame:
    """Raw users that wrote at least one valid review (one row per user)."""
    reviewers = reviews.select(F.col("UserID").alias("user_id")).distinct()
    return user_raw.join(reviewers, "user_id", "left_semi")


def user_valid(user_raw: DataFrame, reviews: DataFrame) -> DataFrame:
    u = users_with_reviews(user_raw, reviews)
    comp = [F.col(c).alias(n) for c, n in zip(schemas.COMPLIMENTS, schemas.USER_COLS[2:13])]
    return u.select(
        F.col("user_id").alias("UserID"), F.col("name").alias("UserName"), *comp,
        F.col("useful").alias("Useful"), F.col("funny").alias("Funny"),
        F.col("cool").alias("Cool"), F.col("fans").alias("Fans"),
        F.col("review_count").alias("ReviewCount"),
        F.col("average_stars").alias("AverageStars"),
        F.expr("try_cast(yelping_since AS DATE)").alias("MemberSince"))


def _list_rows(users: DataFrame, col: str, out: str) -> DataFrame:
    e = users.select(F.col("user_id").alias("UserID"),
                     F.explode(F.transform(F.split(col, ","), lambda x: F.trim(x))).alias(out))
    return e.where(F.col(out).isNotNull() & (F.col(out) != "None") & (F.col(out) != "")).distinct()


def user_friends(user_raw: DataFrame, reviews: DataFrame) -> DataFrame:
    """Distinct (user, friend) edges of valid users; ``None`` means no friend."""
    return _list_rows(users_with_reviews(user_raw, reviews), "friends", "FriendUserID")


def user_elites(user_raw: DataFrame, reviews: DataFrame) -> DataFrame:
    """Distinct (user, elite year) of valid users."""
    return _list_rows(users_with_reviews(user_raw, reviews), "elite", "EliteYear")


def postcode_filter(postcodes: DataFrame) -> DataFrame:
    """Lookup rows whose borough and neighbourhood are both assigned."""
    return postcodes.where((F.col("Borough") != schemas.PLACEHOLDER)
                           & (F.col("Neighbourhood") != schemas.PLACEHOLDER))
