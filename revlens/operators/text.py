"""Review text: cleaning, tokens, mean sentiment, TF-IDF and LDA topics.

Scale notes
* Every step up to the term counts is per review (bounded by review length)
  or a grouped count with map-side combine; no step concatenates all reviews
  of a business into one value, because one business may own a third of all
  reviews. A business's "merged document" is its set of distinct reviews,
  and its term vector is summed from them.
* The businesses of one city are broadcast to the reviews when their
  statistics prove them small, so review text is not shuffled by business.
* TF-IDF keeps every term: document frequencies are a grouped count joined
  back by term. So do the topics, whose model is a table (operators/topics.py).
"""

from __future__ import annotations

import math

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions import text as X
from revlens.operators import topics as L
from revlens.operators.joins import broadcast_if_small, take_bounded
from revlens.sources.io import persist_cut

def city_businesses(business: DataFrame, city: str) -> DataFrame:
    return business.where(F.col("City") == city)


def clean_reviews(reviews: DataFrame, business: DataFrame, city: str) -> DataFrame:
    """Reviews of one city's businesses: ASCII lower-case text and the same
    text without hyperlinks, punctuation and digits (K1)."""
    b = broadcast_if_small(city_businesses(business, city).select("BusinessID", "Name"))
    r = reviews.select("ReviewID", "BusinessID", "Review").join(b, "BusinessID")
    ta = X.ascii_lower(F.col("Review"))
    return (r.select("ReviewID", "BusinessID", "Name", ta.alias("text_ascii"))
             .withColumn("clean_text", X.remove_features(F.col("text_ascii"))))


def tokenize(df: DataFrame, input_col: str, output_col: str = "no_stopword",
             language: str = "english") -> DataFrame:
    """``\\w+`` tokens (lower-cased) without the language's stop words."""
    words = X.STOP_WORDS if language == "english" else StopWordsRemover.loadDefaultStopWords(language)
    tok = RegexTokenizer(inputCol=input_col, outputCol="_tok", pattern=r"\w+", gaps=False)
    sw = StopWordsRemover(inputCol="_tok", outputCol=output_col, stopWords=words)
    return sw.transform(tok.transform(df)).drop("_tok")


def review_tokens(cleaned: DataFrame, language: str = "english") -> DataFrame:
    """Tokens without stop words and their blank-joined text (K2)."""
    t = tokenize(cleaned, "clean_text", "no_stopword", language)
    return t.select("ReviewID", "BusinessID", "Name", "no_stopword",
                    F.array_join("no_stopword", " ").alias("fine_text"))


def business_sentiment(scored: DataFrame, business: DataFrame, city: str) -> DataFrame:
    """Mean scores per business, rounded to 2 digits, with name and place."""
    g = scored.groupBy("BusinessID").agg(
        F.round(F.avg("Negative"), 2).alias("avg_neg"), F.round(F.avg("Neutral"), 2).alias("avg_neu"),
        F.round(F.avg("Positive"), 2).alias("avg_pos"), F.round(F.avg("Compound"), 2).alias("avg_composite_score"))
    b = city_businesses(business, city).select(
        "BusinessID", "Name", X.remove_blanks(F.col("PostalCode")).alias("ZipCode"), "Latitude", "Longitude")
    return g.join(b, "BusinessID")


def merge_reviews(reviews: DataFrame, business: DataFrame, city: str) -> DataFrame:
    """Each city business with its distinct reviews, one row per review.

    Joined first (the city filter prunes reviews before any grouping), then
    de-duplicated per business. The set of rows per business is its merged
    document; it is never concatenated into one value."""
    b = broadcast_if_small(city_businesses(business, city).select(
        "BusinessID", F.col("Name").alias("BusinessName"), "BusinessStars"))
    return reviews.select("BusinessID", "Review").join(b, "BusinessID").distinct()


def term_counts(merged: DataFrame, language: str = "english") -> DataFrame:
    """(BusinessID, term, tf): term frequency of each business document."""
    t = tokenize(merged.select("BusinessID", "Review"), "Review", "terms", language)
    e = t.select("BusinessID", F.explode("terms").alias("term"))
    return e.groupBy("BusinessID", "term").agg(F.count(F.lit(1)).alias("tf"))


# Distinct terms per range partition when ranking the vocabulary (short
# strings and two counts: tens of MB per partition).
TERMS_PER_RANGE = 1_000_000


def vocabulary(tf: DataFrame, vocab_size: int = 1 << 18, min_df: int = 1,
               terms_per_range: int = TERMS_PER_RANGE) -> DataFrame:
    """(term, idx, df): the ``vocab_size`` most frequent terms of the corpus
    (CountVectorizer's rule), ties broken by term, idx 0 the most frequent.

    The global rank is computed without funnelling candidates into one task:
    the distinct terms are range-partitioned by (frequency desc, term) and
    written with their partition id (freezing the range bounds); the per-
    partition sizes (one number per partition) give each partition's offset,
    and a row number within each partition completes the rank. Work and
    memory per task stay proportional to one range partition, whatever the
    number of distinct terms."""
    spark = tf.sparkSession
    tot = (tf.groupBy("term").agg(F.sum("tf").alias("ttf"), F.count(F.lit(1)).alias("df"))
             .where(F.col("df") >= min_df))
    order = [F.desc("ttf"), F.asc("term")]
    tot = tot.persist()  # read by the count, the range sampler and the write
    parts = max(1, math.ceil(tot.count() / terms_per_range))
    ranged = (tot.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                 .withColumn("_pid", F.spark_partition_id()))
    ranged = persist_cut(ranged, spark, "vocab-ranked")
    tot.unpersist()
    sizes = sorted((r["_pid"], r["count"]) for r in take_bounded(ranged.groupBy("_pid").count(), parts))
    offsets, acc = [], 0
    for pid, n in sizes:
        offsets += [F.lit(pid), F.lit(acc)]
        acc += n
    off = F.create_map(*offsets) if offsets else F.create_map().cast("map<int,bigint>")
    w = Window.partitionBy("_pid").orderBy(*order)
    idx = F.element_at(off, F.col("_pid")) + F.row_number().over(w) - 1
    ranked = ranged.select("term", "df", idx.alias("idx"))
    return ranked.where(F.col("idx") < vocab_size).select("term", F.col("idx").cast("int").alias("idx"), "df")


def tfidf_table(merged: DataFrame, language: str = "english") -> DataFrame:
    """(BusinessID, term, tf, idf, tfidf) of the merged documents, every term
    (txt_tfidf)."""
    docs = merged.agg(F.count_distinct("BusinessID").alias("m")).scalar()
    # Written: the weights read the counts twice, which must not split the texts twice.
    return tfidf(persist_cut(term_counts(merged, language), merged.sparkSession, "term-counts"), docs)


def tfidf(tf: DataFrame, n_docs) -> DataFrame:
    """Weights of (BusinessID, term, tf) with idf = ln((m + 1) / (df + 1)).
    df is a grouped count that comes back by a join on the term."""
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((n_docs + F.lit(1)).cast("double") / (F.col("df") + 1))
    return tf.join(df, "term").select("BusinessID", "term", "tf", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf"))


def segments(threshold: float):
    """Low (stars <= threshold) and high (stars > threshold) segments."""
    return F.when(F.col("BusinessStars") <= threshold, "low").when(F.col("BusinessStars") > threshold, "high")


def segment_documents(merged: DataFrame, threshold: float = 3.0) -> DataFrame:
    """The merged documents: (BusinessID, BusinessName, segment); businesses
    without stars are in neither segment."""
    d = merged.select("BusinessID", "BusinessName", segments(threshold).alias("segment"))
    return d.where("segment IS NOT NULL").distinct()


def segment_terms(merged: DataFrame, threshold: float = 3.0, language: str = "english") -> DataFrame:
    """(group, doc, term, weight): TF-IDF weights of the documents of both
    segments, idf taken over all of them; every term."""
    own = segment_documents(merged, threshold).select("BusinessID", F.col("segment").alias("group"))
    return tfidf_table(merged, language).join(own, "BusinessID").select(
        "group", F.col("BusinessID").alias("doc"), "term", F.col("tfidf").alias("weight"))


def topic_words(model: DataFrame, max_terms: int = 10) -> DataFrame:
    """Top words of each topic of each segment."""
    return L.top_terms(model, max_terms).select(F.col("group").alias("segment"), "topic",
                                                F.col("terms").alias("topic_word"))


def topic_distribution(model: DataFrame, terms: DataFrame, documents: DataFrame) -> DataFrame:
    """Mixture of every document under the model, evenly spread for one without
    terms that the model knows."""
    k = L.n_topics(model)
    mixed = L.infer(model, terms).withColumnRenamed("doc", "BusinessID")
    even = F.array(*[F.lit(1.0 / k)] * k)
    return documents.join(mixed, "BusinessID", "left").select(
        "BusinessID", "BusinessName", "segment", F.coalesce("topics", even).alias("topic_distribution"))


def topic_rows(dist: DataFrame) -> DataFrame:
    """A mixture as one (business, topic id, weight) row per topic."""
    return dist.select("BusinessID", "BusinessName", "segment",
                       F.posexplode("topic_distribution").alias("TopicID", "TopicDistribution"))


def topics(merged: DataFrame, threshold: float = 3.0, k: int = 6, seed: int = 123, max_terms: int = 10):
    """Fit one topic model per rating segment; return (words, distributions)."""
    merged = persist_cut(merged, merged.sparkSession, "topic-merged")
    terms = persist_cut(segment_terms(merged, threshold), merged.sparkSession, "topic-terms")
    model, _ = L.fit_topics(terms, k, seed)
    return topic_words(model, max_terms), topic_distribution(model, terms, segment_documents(merged, threshold))
