"""Rating model: training rows, GBT fit and evaluation, and top-N suggestions.

Candidates are (sampled user, business) pairs the user has not reviewed. The
user sample is bounded by ``n_users``; it reaches the plan as one array value
(a scalar subquery) that is exploded against the business rows, so the work is
linear in the number of businesses and no join makes the pairs. The sample's
own reviews are grouped per business (at most ``n_users`` ids each) and joined
on the business key before the explode, so "not visited" is a filter on each
pair and the candidate set is never shuffled.
Top-N per user is a ``row_number`` window filtered to N, which Spark turns
into a partial WindowGroupLimit before the shuffle, so even a user paired
with every business sends at most N rows per map task.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.sources.io import persist_cut

# The model's ten features and the booster's settings.
FEATURES = ["UserReviewCount", "UserAverageStars", "Latitude", "Longitude",
            "BusinessNeighborhoodIndexed", "ReviewDayOfYear", "AverageNegative",
            "AverageNeutral", "AveragePositive", "AverageComposite"]
MAX_ITER, MAX_DEPTH, MAX_BINS = 5, 10, 110


def _business_side(sentiment: DataFrame) -> DataFrame:
    s = sentiment.where(F.col("ZipCode").isNotNull())
    return s.select(
        "BusinessID", F.col("Name").alias("BusinessName"), F.col("ZipCode").alias("BusinessPostalCode"),
        F.substring("ZipCode", 1, 3).alias("BusinessNeighborhood"),
        F.col("Latitude").try_cast("double").alias("Latitude"),
        F.col("Longitude").try_cast("double").alias("Longitude"),
        F.col("avg_neg").try_cast("double").alias("AverageNegative"),
        F.col("avg_neu").try_cast("double").alias("AverageNeutral"),
        F.col("avg_pos").try_cast("double").alias("AveragePositive"),
        F.col("avg_composite_score").try_cast("double").alias("AverageComposite"))


def features(reviews: DataFrame, users: DataFrame, sentiment: DataFrame) -> DataFrame:
    """One training row per review: user profile, review day, business place
    and business sentiment (rec_features)."""
    ru = reviews.join(users, "UserID").select(
        "BusinessID", "UserID", "UserName", F.col("ReviewCount").alias("UserReviewCount"),
        F.col("AverageStars").alias("UserAverageStars"), "ReviewStars",
        F.dayofyear("Date").alias("ReviewDayOfYear"))
    return ru.join(_business_side(sentiment), "BusinessID")


def fit(train: DataFrame, seed: int = 42, max_iter: int = MAX_ITER, max_depth: int = MAX_DEPTH,
        max_bins: int = MAX_BINS) -> PipelineModel:
    """Index the neighbourhood, fill missing numbers with the training mean,
    assemble, boost. No row is dropped: fit, evaluation and scoring share the
    one rule for missing values. ``max_bins`` grows with the number of
    neighbourhoods (an unseen one is a category of its own)."""
    numbers = [c for c in FEATURES if c != "BusinessNeighborhoodIndexed"]
    doubled = train.withColumns({c: F.col(c).cast("double") for c in numbers})
    known = doubled.agg(*[F.count(F.col(c)).alias(c) for c in numbers]).first()
    fill = [c for c in numbers if known[c]]  # a column without any number tells nothing and is left out
    indexer = StringIndexer(inputCol="BusinessNeighborhood", outputCol="BusinessNeighborhoodIndexed",
                            handleInvalid="keep").fit(train)
    imputer = Imputer(inputCols=fill, outputCols=[f"{c}_filled" for c in fill])
    assembler = VectorAssembler(inputCols=[*[f"{c}_filled" for c in fill], "BusinessNeighborhoodIndexed"],
                                outputCol="features")
    gbt = GBTRegressor(featuresCol="features", labelCol="ReviewStars", maxIter=max_iter, maxDepth=max_depth,
                       maxBins=max(max_bins, len(indexer.labels) + 1), seed=seed)
    rest = Pipeline(stages=[imputer, assembler, gbt]).fit(indexer.transform(_numbers(train)))
    return PipelineModel([indexer, *rest.stages])


def _numbers(rows: DataFrame) -> DataFrame:
    """The numeric features as doubles (the imputer and its model want one type)."""
    return rows.withColumns({c: F.col(c).cast("double") for c in FEATURES if c in rows.columns})


#: Share of the rows that a model is trained on; columns that tell a row's side.
TRAIN_SHARE = 0.75
SPLIT_BY = ("BusinessID", "UserID", "ReviewDayOfYear", "ReviewStars")


def split_side(rows: DataFrame, seed: int = 42, share: float = TRAIN_SHARE) -> Column:
    """Whether a row is for training: by the MD5 of the seed and the row's business,
    user, day and stars. It is a property of the row alone, so a recomputed parent, in
    whatever order, never moves a row between the sides; equal rows keep together."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("-"))
                                               for c in ("BusinessID", "UserID", "ReviewDayOfYear")],
                      F.coalesce(F.col("ReviewStars").cast("int").cast("string"), F.lit("-")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 10_000 < int(share * 10_000)


def regression_metrics(pred: DataFrame, label: str = "ReviewStars", prediction: str = "prediction") -> DataFrame:
    """One row (n, r2, rmse) from sums over a table of predictions, combined
    map-side. Rows without label or prediction do not count; r2 is null where all
    labels are equal."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    t = pred.where(y.isNotNull() & p.isNotNull())
    t = t.agg(F.count(F.lit(1)).alias("n"), F.sum((y - p) * (y - p)).alias("sse"), F.sum(y).alias("s"),
              F.sum(y * y).alias("ss"))
    spread = F.col("ss") - F.col("s") * F.col("s") / F.col("n")
    return t.select("n", (1 - F.col("sse") / F.when(spread > 0, spread)).alias("r2"),
                    F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))


def train_eval(rows: DataFrame, seed: int = 42, share: float = TRAIN_SHARE, **gbt):
    """Fit on the training side of the split; r2 and rmse on all rows of the rest.
    What fit, split and evaluation read is written once, so both sides and every pass
    read it back; the executors' memory is left to the booster's own points."""
    need = {*FEATURES, *SPLIT_BY, "BusinessNeighborhood"}
    rows = _numbers(rows).select(*[c for c in rows.columns if c in need])
    rows = persist_cut(rows, rows.sparkSession, "rec-train-rows")
    side = split_side(rows, seed, share)
    model = fit(rows.where(side), seed, **gbt)
    m = regression_metrics(model.transform(rows.where(~side))).first()
    return model, {"r2": m["r2"] if m["r2"] is not None else float("nan"),
                   "rmse": m["rmse"] if m["rmse"] is not None else float("nan")}


def sample_users(users: DataFrame, n_users: int) -> DataFrame:
    """The first ``n_users`` users by id (a fixed, reproducible sample)."""
    return users.select("UserID", "UserName", F.col("ReviewCount").alias("UserReviewCount"),
                        F.col("AverageStars").alias("UserAverageStars")).orderBy("UserID").limit(n_users)


def candidates(users: DataFrame, reviews: DataFrame, sentiment: DataFrame,
               n_users: int = 50, as_of: str | None = None) -> DataFrame:
    """Unvisited (user, business) pairs of the user sample, with features.
    ``as_of``: the day of the supposed review, today by default."""
    sample = persist_cut(sample_users(users, n_users), users.sparkSession, "rec-users")  # n_users rows
    everyone = sample.agg(F.array_sort(F.collect_list(F.struct(*sample.columns)))).scalar()
    # Each business's reviewers among the sample: at most n_users ids per
    # business, combined map-side.
    seen = (reviews.join(F.broadcast(sample.select("UserID")), "UserID", "left_semi").groupBy("BusinessID")
            .agg(F.collect_set("UserID").alias("_seen")))
    biz = _business_side(sentiment).join(seen, "BusinessID", "left")
    pairs = biz.select("*", F.explode(everyone).alias("u"))
    unseen = ~F.coalesce(F.array_contains(F.col("_seen"), F.col("u.UserID")), F.lit(False))
    day = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    return pairs.where(unseen).select(
        "BusinessID", "u.UserID", "u.UserName", "u.UserReviewCount", "u.UserAverageStars",
        F.lit(0).alias("ReviewStars"), F.dayofyear(day).alias("ReviewDayOfYear"),
        "BusinessName", "BusinessPostalCode", "BusinessNeighborhood", "Latitude", "Longitude",
        "AverageNegative", "AverageNeutral", "AveragePositive", "AverageComposite")


def fixed_score(cands: DataFrame) -> DataFrame:
    """A deterministic stand-in for the model's prediction, used to check the
    top-N step exactly: user mean star moved by the business's sentiment."""
    return cands.withColumn("PredictedReviewStar",
                            F.col("UserAverageStars")
                            + F.lit(3.0) * (F.col("AveragePositive") - F.col("AverageNegative")))


def predict(model: PipelineModel, cands: DataFrame) -> DataFrame:
    """Score every candidate; the model's own rule fills missing numbers."""
    scored = model.transform(_numbers(cands)).withColumnRenamed("prediction", "PredictedReviewStar")
    return scored.withColumns({c: F.col(c).cast(t) for c, t in cands.dtypes if c in FEATURES})


def top_n(pred: DataFrame, n: int = 10) -> DataFrame:
    """Clamp scores to [0, 5] and keep each user's n best, ties by BusinessID."""
    out = pred.select(
        "BusinessID", "BusinessName", "BusinessPostalCode", "BusinessNeighborhood", "UserID", "UserName",
        "UserReviewCount", "UserAverageStars", "ReviewDayOfYear", "PredictedReviewStar", "Latitude",
        "Longitude", "AverageNegative", "AverageNeutral", "AveragePositive", "AverageComposite",
        F.least(F.greatest(F.col("PredictedReviewStar"), F.lit(0.0)), F.lit(5.0)).alias("FinalStar"))
    w = Window.partitionBy("UserID").orderBy(F.desc("FinalStar"), "BusinessID")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
