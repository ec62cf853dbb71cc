"""Stand-in raw inputs built from the driver's test tables.

The operators are written for the raw shapes of the public review dataset
(see FIXTURES.md). These adapters derive such records from the TPC-H-like
test tables so that every registered query reads the given tables and its
work grows with them. Each adapter has a twin in :mod:`revlens.plans.oracle`
that builds the same rows in DuckDB SQL.

Mapping (all row-local or grouped with bounded state):

* business <- part: id p_partkey, state p_type, city p_brand, categories the
  words of p_name (+ "Food Court" on even sizes), attributes from p_size and
  the first name word, postcode ``M<partkey mod 25> <size>`` (short when
  size is a multiple of 7), stars from p_size (null on multiples of 11).
* province <- distinct p_type except PROMO.
* review <- lineitem join orders: business l_partkey, user o_custkey, date
  o_orderdate, stars the first digit of o_orderpriority.
* user <- customer left join its orders: review count, mean star, first
  order date, elite = order years, friends = (orderkey mod 101) of orders in
  status P (``None`` when there is none).
* checkin <- events: business user_id, two times per event (ts and ts plus
  floor(value) days) packed as text with a trailing comma.
* postcode / ethnicity / labour <- nation, region, customer.

Field values are derived by rules (modulo of a size, a word of a name); none
of them filters rows. Rows are dropped only by the operators' own validity
rules (closed, unlisted province, short postcode, null stars), as the
reference's ETL drops them.
* text reviews <- all documents; business = source and class, the class being
  the label's quality where there is one and doc_id mod 2 elsewhere, so that
  both rating segments hold labelled and unlabelled documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.joins import broadcast_if_small
from revlens.schemas import COMPLIMENTS
from revlens.sources.io import read_parquet

ATTRIBUTE_FIELDS = ["BikeParking", "WiFi", "RestaurantsPriceRange2", "Ambience", "GoodForMeal"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Those with much work per row (texts, packed times) are
    dealt over all cores first; the others are scanned as they are split."""
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", spread=name in ("documents", "events"))


def business_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    attrs = F.struct(
        F.expr("CASE p_size % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END").alias("BikeParking"),
        F.expr("CASE p_size % 4 WHEN 0 THEN 'u''free''' WHEN 1 THEN 'u''no''' "
               "WHEN 2 THEN '''paid''' END").alias("WiFi"),
        F.expr("CAST(p_size % 4 + 1 AS STRING)").alias("RestaurantsPriceRange2"),
        F.expr("concat('{''romantic'': ', CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END, "
               "', ''casual'': ', CASE WHEN p_size % 5 < 2 THEN 'True' ELSE 'False' END, "
               "', ''', split_part(p_name, ' ', 1), ''': True}')").alias("Ambience"),
        F.expr("CASE WHEN p_size % 6 = 0 THEN '{''dessert'': False, ''latenight'' True}' "
               "WHEN p_size % 6 = 1 THEN 'None' "
               "ELSE '{''lunch'': True, ''dinner'': None}' END").alias("GoodForMeal"),
    )
    return p.select(
        F.expr("CAST(p_partkey AS STRING)").alias("business_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("state"),
        F.col("p_brand").alias("city"),
        F.expr("concat('M', lpad(CAST(p_partkey % 25 AS STRING), 2, '0'), ' ', "
               "CASE WHEN p_size % 7 = 0 THEN CAST(p_size AS STRING) "
               "ELSE lpad(CAST(p_size AS STRING), 3, '0') END)").alias("postal_code"),
        F.expr("43.0D + p_retailprice / 10000.0D").alias("latitude"),
        F.expr("-79.0D - p_size / 100.0D").alias("longitude"),
        F.expr("CASE WHEN p_size % 11 = 0 THEN NULL ELSE (p_size % 9) * 0.5D + 1.0D END").alias("stars"),
        F.expr("CAST(p_size * 3 AS BIGINT)").alias("review_count"),
        F.expr("CAST(CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1 END AS BIGINT)").alias("is_open"),
        F.expr("concat(split_part(p_name, ' ', 1), ', ', split_part(p_name, ' ', 2), "
               "CASE WHEN p_size % 2 = 0 THEN ', Food Court' ELSE '' END)").alias("categories"),
        attrs.alias("attributes"),
    )


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (p.select(F.col("p_type").alias("code"), F.initcap("p_type").alias("province"))
             .where(F.col("code") != "PROMO").distinct())


def review_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.expr("concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))").alias("review_id"),
        F.expr("CAST(l_partkey AS STRING)").alias("business_id"),
        F.expr("CAST(o_custkey AS STRING)").alias("user_id"),
        F.expr("concat('Line ', CAST(l_linenumber AS STRING), ' of order ', "
               "CAST(l_orderkey AS STRING), '\n', l_returnflag, l_linestatus)").alias("text"),
        F.expr("CAST(CAST(o_orderdate AS DATE) AS STRING)").alias("date"),
        F.expr("CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)").alias("stars"),
        F.expr("CAST(l_quantity AS BIGINT) % 5").alias("cool"),
        F.expr("CAST(round(l_tax * 100) AS BIGINT)").alias("funny"),
        F.expr("CAST(round(l_discount * 100) AS BIGINT)").alias("useful"),
    )


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw reviews as JSON lines (file, record), some of them broken: those of
    order numbers divisible by 101 are cut in half, of 103 have words for stars."""
    r = review_raw(spark, sf_dir)
    line = F.to_json(F.struct(*r.columns))
    order = F.split_part("review_id", F.lit("-"), F.lit(1)).cast("long")
    record = (F.when(order % 101 == 0, F.left(line, (F.length(line) / 2).cast("int")))
              .when(order % 103 == 0, F.regexp_replace(line, r'"stars":[0-9.]+', '"stars":"many"')).otherwise(line))
    return r.select(F.lit("reviews").alias("file"), record.alias("record"))


def user_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.expr("CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)")).alias("avg_star"),
        F.min("o_orderdate").alias("first"),
        F.array_sort(F.collect_set(F.expr("CAST(year(o_orderdate) AS STRING)"))).alias("years"),
        F.array_sort(F.collect_set(F.expr(
            "CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey % 101 AS STRING) END"))).alias("friends"))
    j = c.join(per, "c_custkey", "left")
    comp = [F.expr(f"CAST(c_nationkey % {i + 2} AS BIGINT)").alias(n)
            for i, n in enumerate(COMPLIMENTS)]
    return j.select(
        F.expr("CAST(c_custkey AS STRING)").alias("user_id"), F.col("c_name").alias("name"), *comp,
        F.expr("CAST(floor(abs(c_acctbal)) AS BIGINT) % 50").alias("useful"),
        F.expr("CAST(c_nationkey AS BIGINT)").alias("funny"),
        F.expr("CAST(floor(abs(c_acctbal)) AS BIGINT) % 7").alias("cool"),
        F.expr("CASE WHEN size(friends) > 0 THEN array_join(friends, ', ') ELSE 'None' END").alias("friends"),
        F.expr("CAST(c_nationkey % 5 AS BIGINT)").alias("fans"),
        F.expr("coalesce(array_join(years, ','), '')").alias("elite"),
        F.expr("coalesce(n, 0)").alias("review_count"),
        F.col("avg_star").alias("average_stars"),
        F.expr("CAST(CAST(first AS DATE) AS STRING)").alias("yelping_since"),
    )


def _wall_clock_text(ts: str) -> str:
    """``yyyy-MM-dd HH:mm:ss`` of a TIMESTAMP_NTZ from its fields, so no
    session time zone is involved."""
    return (f"format_string('%04d-%02d-%02d %02d:%02d:%02d', year({ts}), month({ts}), "
            f"dayofmonth({ts}), hour({ts}), minute({ts}), second({ts}))")


def checkin_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    later = "timestampadd(DAY, CAST(floor(value) AS INT), ts)"
    return e.select(
        F.expr("CAST(user_id AS STRING)").alias("business_id"),
        F.expr(f"concat({_wall_clock_text('ts')}, ', ', {_wall_clock_text(later)}, ',')").alias("date"))


def postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postcode lookup as its CSV arrives: strings, with placeholder rows."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return j.select(
        F.expr("concat('M', lpad(CAST(n_nationkey AS STRING), 2, '0'))").alias("Postcode"),
        F.expr("CASE WHEN n_nationkey % 8 = 7 THEN 'Not assigned' ELSE r_name END").alias("Borough"),
        F.expr("CASE WHEN n_nationkey = 12 THEN 'Not assigned' ELSE n_name END").alias("Neighbourhood"))


def _per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    agg = c.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("pop"),
        F.count_if(F.col("c_acctbal") > 0).alias("pos"),
        *[F.count_if(F.col("c_mktsegment") == s).alias(s) for s in SEGMENTS])
    return n.join(agg, "n_nationkey")


def ethnicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population by group per neighbourhood, as a CSV with padded headers."""
    j = _per_nation(spark, sf_dir)
    return j.select(F.col("n_name").alias(" Neighbourhood "),
                    F.col("pop").cast("string").alias(" Total Population"),
                    *[F.col(s).cast("string").alias(f" {s} ") for s in SEGMENTS])


def labour(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _per_nation(spark, sf_dir)
    return j.select(F.col("n_name").alias("Neighbourhood "),
                    F.col("n_nationkey").cast("string").alias(" NeighbourhoodId"),
                    F.lit("x").alias(" CombinedIndicators"),
                    F.col("pop").cast("string").alias(" TotalPopulation"),
                    F.col("pop").cast("string").alias(" LabourForceCategory "),
                    F.col("pos").cast("string").alias(" InLabourForce "),
                    (F.col("pop") - F.col("pos")).cast("string").alias(" Unemployed "))


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a review (clean review shape)."""
    return _classed(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("ReviewID"),
        F.expr("concat(source, '_q', CAST(class AS STRING))").alias("BusinessID"),
        F.expr("concat('u', CAST(doc_id % 97 AS STRING))").alias("UserID"),
        F.col("text").alias("Review"),
        F.expr("CASE WHEN class = 1 THEN 5.0D ELSE 1.0D END").alias("ReviewStars"))


def _classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their class: the labelled quality, else doc_id mod 2."""
    d = table(spark, sf_dir, "documents")
    lb = broadcast_if_small(table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return d.join(lb, "doc_id", "left").withColumn("class", F.expr("coalesce(CAST(quality AS BIGINT), doc_id % 2)"))


def text_businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One business per source of the documents and class."""
    k = (read_parquet(spark, f"{sf_dir}/documents.parquet").select("source").distinct()
         .select("source", F.explode(F.array(F.lit(0), F.lit(1))).alias("class")))
    num = "CAST(substr(source, 4) AS INT)"
    return k.select(
        F.expr("concat(source, '_q', CAST(class AS STRING))").alias("BusinessID"),
        F.col("source").alias("Name"),
        F.expr(f"CASE WHEN {num} % 4 = 3 THEN 'Markham' ELSE 'Toronto' END").alias("City"),
        F.expr(f"concat('M', lpad(CAST({num} % 25 AS STRING), 2, '0'), ' 1A', CAST(class AS STRING))")
        .alias("PostalCode"),
        F.expr(f"43.6D + {num} / 1000.0D").alias("Latitude"),
        F.expr(f"-79.4D - {num} / 1000.0D").alias("Longitude"),
        F.expr("CASE WHEN class = 1 THEN 5.0D ELSE 1.0D END").alias("BusinessStars"))


def rec_sentiment(reviews: DataFrame, business: DataFrame) -> DataFrame:
    """Business sentiment stand-in for the recommender: the review table has
    no text, so the four scores are scaled means of the review vote counts
    (each one integer ratio, so both engines round it identically). Shape
    and types are those of the text layer's business sentiment."""
    n = F.count(F.lit(1))

    def ratio(num, scale):
        return num.cast("double") / (n * scale).cast("double")

    g = reviews.groupBy("BusinessID").agg(
        ratio(F.sum("Funny"), 10).alias("avg_neg"),
        ratio(F.sum("Cool"), 5).alias("avg_neu"),
        ratio(F.sum("Useful"), 10).alias("avg_pos"),
        ratio(F.sum("Useful") - F.sum("Funny"), 10).alias("avg_composite_score"))
    b = business.select("BusinessID", "Name", F.regexp_replace("PostalCode", " ", "").alias("ZipCode"),
                        "Latitude", "Longitude")
    return g.join(b, "BusinessID")
