"""Businesses joined with neighbourhood statistics through postcode prefixes.

Lookup CSVs arrive as strings with padded headers; names are stripped and
numbers parsed with ``try_cast`` so one dirty cell gives a null, not a
failed job. Neighbourhood tables are dimensions: they are broadcast when a
row-count check proves them small, otherwise Spark picks a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.joins import broadcast_if_small
from revlens.sources.io import strip_header


def _with_prefix(business: DataFrame) -> DataFrame:
    """First part of the postcode (the forward sortation area)."""
    return business.withColumn("PostCode", F.substring_index("PostalCode", " ", 1))


def group_shares(ethnicity: DataFrame, postcodes: DataFrame, groups: list[str],
                 total_col: str = "Total Population") -> DataFrame:
    """Share of each listed group in its neighbourhood's population, with the
    neighbourhood's postcode. A zero or unparsable population gives null."""
    e = strip_header(ethnicity).join(postcodes.select("Neighbourhood", "Postcode"),
                                     "Neighbourhood", "left")
    pop = F.col(f"`{total_col}`").try_cast("double")
    shares = [F.try_divide(F.col(f"`{g}`").try_cast("double"), pop).alias(g) for g in groups]
    return e.select("Neighbourhood", F.col(f"`{total_col}`"), *shares,
                    F.col("Postcode").alias("PostCode"))


def group_share(business: DataFrame, postcodes: DataFrame, ethnicity: DataFrame,
                city_like: str, category_like: str, groups: list[str]) -> DataFrame:
    """Businesses of one cuisine in one city with the population shares of
    their neighbourhood, best rated first."""
    b = business.where(F.col("City").like(city_like) & F.col("Categories").like(category_like))
    s = broadcast_if_small(group_shares(ethnicity, postcodes, groups))
    j = _with_prefix(b).join(s, "PostCode", "left")
    return (j.select("BusinessID", "Name", "Latitude", "Longitude", "BusinessStars",
                     "Neighbourhood", *[F.col(f"`{g}`") for g in groups])
             .orderBy(F.desc("BusinessStars"), "BusinessID"))


def labour_table(labour: DataFrame, postcodes: DataFrame) -> DataFrame:
    lb = strip_header(labour).join(postcodes.select("Neighbourhood", "Postcode"), "Neighbourhood", "left")
    lb = lb.drop("CombinedIndicators", "Borough", "TotalPopulation")
    return (lb.withColumn("LabourForceCategory", F.col("LabourForceCategory").try_cast("int"))
              .withColumn("InLabourForce", F.col("InLabourForce").try_cast("int"))
              .withColumnRenamed("Postcode", "PostCode"))


def labour_ratio(business: DataFrame, postcodes: DataFrame, labour: DataFrame,
                 city_like: str, digits: int = 6) -> DataFrame:
    """Mean stars and mean employment ratio (in labour force / labour force
    category) per neighbourhood, over businesses whose joined row is complete."""
    b = business.where(F.col("City").like(city_like))
    j = _with_prefix(b).join(broadcast_if_small(labour_table(labour, postcodes)), "PostCode", "left")
    j = j.na.drop()  # rows with any missing field, unmatched neighbourhoods included
    r = j.select("Neighbourhood", "BusinessStars",
                 F.try_divide(F.col("InLabourForce").cast("double"),
                              F.col("LabourForceCategory").cast("double")).alias("ratio_emply"))
    return r.groupBy("Neighbourhood").agg(
        F.round(F.avg("BusinessStars"), digits).alias("BusinessStars"),
        F.round(F.avg("ratio_emply"), digits).alias("ratio_emply"))
