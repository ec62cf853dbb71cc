"""Suggestions for every user without scoring every (user, business) pair.

For scores that rise with a value of the business (user's mean star plus the
business's lean, cut to [0, 5]), a business stands behind another for every user if
its value is no larger and its id comes later. One with ``want`` others before it in
this sense is in no user's list of ``want``; of N businesses some ``want * log(N)``
are left. Lists depend on the user's value alone: each distinct value gets one of
``want``, and a user who has not reviewed ``n`` of its businesses or more is done.
The few others ask for longer lists, until a list holds all businesses. The result
is exact; the number of (value, business) pairs scored is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.sources.io import persist_cut

#: Businesses before the first bound; length of the first lists in ``n``, and its
#: growth from round to round; rows of a range of ids.
BLOCK, FIRST, GROWTH, ROWS_PER_RANGE = 128, 2, 4, 100_000


def _cut(score: Column) -> Column:
    """Scores in [0, 5]; a missing one counts as 0."""
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(5.0))


def _in_segments(businesses: DataFrame, n_biz: int, block: int) -> DataFrame:
    """(BusinessID, b, segment), written: businesses in the order of their ids lie in
    segments, the first of ``block`` rows, each other as long as all before it."""
    spark = businesses.sparkSession
    ranged = businesses.select("BusinessID", F.col("value").alias("b")).repartitionByRange(
        n_biz // ROWS_PER_RANGE + 1, "BusinessID").sortWithinPartitions("BusinessID")
    ranged = persist_cut(ranged.withColumn("_part", F.spark_partition_id())
                         .withColumn("_row", F.monotonically_increasing_id()), spark, "suggest-ranked")
    # One number for each range comes to the driver.
    at, before = F.lit(None), 0
    for r in ranged.groupBy("_part").count().orderBy("_part").collect():
        at = F.when(F.col("_part") == r["_part"], before).otherwise(at)
        before += r["count"]
    row = at + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    q = F.floor(row / block)
    return persist_cut(ranged.select("BusinessID", "b", F.when(q == 0, 0).otherwise(
        F.length(F.bin(q))).alias("segment")), spark, "suggest-segments")


def _contenders(biz: DataFrame, n_biz: int, want: int) -> DataFrame:
    """Businesses that can be among the best ``want`` of some user, and some others:
    those above the ``want``-th largest value of all segments before their own."""
    if want >= n_biz:
        return biz
    high = F.desc_nulls_last("b")
    own = Window.partitionBy("segment").orderBy(high)
    top = biz.select("segment", "b").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= want)
    last = top.agg(F.max("segment")).scalar()
    later = top.select("b", F.explode(F.expr("sequence(segment + 1, segment + 64)")).alias("segment")).where(
        F.col("segment") <= last)
    bound = later.withColumn("rank", F.row_number().over(own)).where(F.col("rank") == want)
    behind = F.lit(False)  # one number for each segment: as many as twice the rows have binary digits at most
    for r in bound.select("segment", "b").collect():
        behind = behind | ((F.col("segment") == r["segment"]) & (F.col("b").isNull() if r["b"] is None else (
            F.col("b").isNull() | (F.col("b") <= F.lit(r["b"])))))
    return biz.where(~behind)


def top_for_all(users: DataFrame, reviews: DataFrame, businesses: DataFrame, n: int = 10,
                block: int = BLOCK) -> tuple[DataFrame, dict]:
    """The ``n`` best businesses that each user has not reviewed.

    ``users``: UserID, value (double); ``businesses``: BusinessID, value (double);
    ``reviews``: UserID, BusinessID, repeats allowed; ids unique and not null. The
    score of a pair is the sum of the values, cut to [0, 5], 0 where one is null.
    Returns (UserID, BusinessID, FinalStar, rank), ties by BusinessID, and a report:
    pairs scored, pairs in all, rounds.
    """
    spark = users.sparkSession
    n_biz, n_users = businesses.count(), users.count()
    report = {"scored": 0, "pairs": n_biz * n_users, "rounds": 0}
    biz = _in_segments(businesses, n_biz, block)
    place = Window.partitionBy("u").orderBy(F.desc("FinalStar"), "BusinessID")
    by = Window.partitionBy("UserID").orderBy(F.desc("FinalStar"), "BusinessID")
    active = users.select("UserID", F.col("value").alias("u"))
    done, want = [], FIRST * n
    while True:
        active = persist_cut(active, spark, "suggest-active")
        values = persist_cut(active.select("u").distinct(), spark, "suggest-values")
        some = persist_cut(_contenders(biz, n_biz, want).select("BusinessID", "b"), spark, "suggest-contenders")
        scored = values.count() * some.count()
        report["scored"] += scored
        report["rounds"] += scored > 0
        # Dealt out by number, so that few values do not make one task.
        pairs = values.repartition(4 * spark.sparkContext.defaultParallelism).crossJoin(some)
        lists = pairs.select("u", "BusinessID", _cut(F.col("u") + F.col("b")).alias("FinalStar"))
        lists = persist_cut(lists.withColumn("place", F.row_number().over(place)).where(F.col("place") <= want)
                            .select(F.col("u").alias("of"), "BusinessID", "FinalStar"), spark, "suggest-lists")
        here = reviews.select("UserID", "BusinessID").join(some.select("BusinessID"), "BusinessID", "left_semi")
        new = active.join(lists, F.col("u").eqNullSafe(F.col("of"))).select("UserID", "BusinessID", "FinalStar")
        new = new.join(here, ["UserID", "BusinessID"], "left_anti")
        best = persist_cut(new.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= n), spark,
                           "suggest-best")
        if want >= n_biz:  # the lists held everything
            done.append(best)
            break
        full = best.where(F.col("rank") == n).select("UserID")
        done.append(best.join(full, "UserID", "left_semi"))
        active = active.join(full, "UserID", "left_anti")
        want *= GROWTH
        if not active.take(1):
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    # A user that is listed more than once gets the list each time.
    more = persist_cut(users.groupBy("UserID").agg((F.count(F.lit(1)) - 1).alias("more")).where("more > 0"), spark,
                       "suggest-more")
    out = out.join(more, "UserID", "left").withColumn("_i", F.explode(F.sequence(F.lit(0), F.coalesce(
        F.col("more").cast("int"), F.lit(0)))))
    return out.select("UserID", "BusinessID", "FinalStar", F.col("rank").cast("int").alias("rank")), report
