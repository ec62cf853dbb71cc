"""The reviews of each business as one text, in chunks of bounded size.

One business may own a third of all reviews, so its text is no single value. Its
reviews are put in the order of a hash; the hash range is cut into as many equal
parts as the business has chunks of text, so a large business is many groups of
about one chunk, whatever its share of the rows. A group's text is cut into pieces
of the exact size; a running count of pieces over the groups, one narrow row each,
numbers them. Joining the chunks of a business in order gives its whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.sources.io import persist_cut

#: Characters of a chunk.
CHUNK_CHARS = 1 << 20


def merged_text(merged: DataFrame, chunk_chars: int = CHUNK_CHARS, sep: str = " ") -> DataFrame:
    """(BusinessID, chunk, text) of ``merged`` (BusinessID, Review; other columns
    are ignored; see :func:`revlens.operators.text.merge_reviews`).

    The text of a business is its distinct reviews joined by ``sep``, in the order of
    the first 32 bits of their MD5 and then of the reviews themselves, so it depends
    on nothing but the reviews. Chunks count from 0 and hold at most ``chunk_chars``
    characters. Null reviews are left out; a business whose reviews are all empty
    has one empty chunk. A group holds about one chunk, or its largest review.
    """
    spark = merged.sparkSession
    gap = len(sep)
    r = merged.where("BusinessID IS NOT NULL AND Review IS NOT NULL").select("BusinessID", "Review").distinct()
    r = persist_cut(r.select("*", F.conv(F.substring(F.md5("Review"), 1, 8), 16, 10).cast("long").alias("_h"),
                             (F.length("Review") + gap).cast("long").alias("_n")), spark, "merged-reviews")
    parts = r.groupBy("BusinessID").agg(F.ceil(F.sum("_n") / chunk_chars).alias("_parts"))
    part = F.shiftright(F.col("_h") * F.greatest("_parts", F.lit(1)), 32)
    rows = r.join(parts, "BusinessID").withColumn("_part", part).drop("_parts")
    # Numbers of the pieces: one row for each group of about a chunk.
    own = Window.partitionBy("BusinessID").orderBy("_part")
    size = rows.groupBy("BusinessID", "_part").agg(F.sum("_n").alias("_n"))
    first = F.row_number().over(own) == 1
    chars = F.col("_n") - F.when(first, gap).otherwise(0)
    size = size.select("BusinessID", "_part", first.alias("_first"),
                       F.greatest(F.ceil(chars / chunk_chars), F.when(first, 1).otherwise(0)).alias("_pieces"))
    before = F.sum("_pieces").over(own.rowsBetween(Window.unboundedPreceding, -1))
    size = size.select("BusinessID", "_part", "_first", "_pieces", F.coalesce(before, F.lit(0)).alias("_before"))
    text = rows.groupBy("BusinessID", "_part").agg(F.array_sort(F.collect_list(F.struct("_h", "Review"))).alias("_r"))
    joined = F.concat(F.when(F.col("_first"), "").otherwise(sep), F.array_join("_r.Review", sep))
    text = text.join(size, ["BusinessID", "_part"]).select("BusinessID", "_before", "_pieces", joined.alias("_text"))
    each = text.where("_pieces > 0").withColumn("_i", F.explode(F.expr("sequence(0, CAST(_pieces AS INT) - 1)")))
    return each.select("BusinessID", (F.col("_before") + F.col("_i")).cast("long").alias("chunk"),
                       F.substring("_text", F.col("_i") * chunk_chars + 1, F.lit(chunk_chars)).alias("text"))
