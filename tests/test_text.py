"""Text layer: cleaning rules, lexicon sentiment (both strategies), topics."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from revlens.operators import text as T

BIZ = "BusinessID string, Name string, City string, PostalCode string, Latitude double, " \
      "Longitude double, BusinessStars double"
REV = "ReviewID string, BusinessID string, Review string"


def test_clean_reviews(spark):
    b = spark.createDataFrame([("b1", "B", "Toronto", "M1A 1A1", 0.0, 0.0, 4.0),
                               ("b2", "C", "Paris", "M1A 1A1", 0.0, 0.0, 4.0)], BIZ)
    r = spark.createDataFrame([
        ("1", "b1", "Café GREAT!! see https://www.example.com/menu/today now 42times"),
        ("2", "b1", ""), ("3", "b2", "other city")], REV)
    out = {x.ReviewID: x for x in T.clean_reviews(r, b, "Toronto").collect()}
    assert sorted(out) == ["1", "2"]
    assert out["1"].text_ascii == "caf great!! see https://www.example.com/menu/today now 42times"
    assert out["1"].clean_text.split() == ["caf", "great", "see", "now", "times"]
    assert out["2"].clean_text == ""


def test_tokens_drop_stop_words(spark):
    df = spark.createDataFrame([("1", "b", "n", "the food was not good and the staff")],
                               "ReviewID string, BusinessID string, Name string, clean_text string")
    got = T.review_tokens(df).collect()[0]
    assert got.fine_text == "food good staff"


def test_city_businesses_are_broadcast_to_the_text(spark):
    from revlens.plans import catalog as C
    plan = C.text_clean(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(BusinessID" not in plan.replace("#", " ") and "SortMergeJoin" not in plan


def test_merge_and_tfidf(spark):
    b = spark.createDataFrame([("b1", "B", "Toronto", "M", 0.0, 0.0, 5.0),
                               ("b2", "C", "Toronto", "M", 0.0, 0.0, 1.0)], BIZ)
    r = spark.createDataFrame([("1", "b1", "tasty noodles"), ("2", "b1", "tasty noodles"),
                               ("3", "b1", "noodles again"), ("4", "b2", "cold soup")], REV)
    merged = T.merge_reviews(r, b, "Toronto")
    assert merged.where("BusinessID = 'b1'").count() == 2  # equal reviews counted once
    tf = T.term_counts(merged)
    got = {(x.BusinessID, x.term): x.tf for x in tf.collect()}
    assert got[("b1", "noodles")] == 2 and got[("b2", "soup")] == 1
    vocab = T.vocabulary(tf)
    w = {(x.BusinessID, x.term): x for x in T.tfidf_table(merged).collect()}
    assert len(w) == len(got)
    assert abs(w[("b1", "noodles")].idf - math.log(3 / 2)) < 1e-12
    assert vocab.orderBy("idx").first().term == "noodles"  # most frequent term first


def test_topics_sum_to_one(spark):
    b = spark.createDataFrame([(f"b{i}", "N", "Toronto", "M", 0.0, 0.0, 5.0 if i % 2 else 1.0)
                               for i in range(8)], BIZ)
    vocab = ["soup", "noodle", "rice", "tea", "cake", "bread", "fish", "salad"]
    r = spark.createDataFrame([(str(i * 10 + j), f"b{i}", " ".join(vocab[(i + j) % 8] for j in range(5)))
                               for i in range(8) for j in range(3)], REV)
    words, dist = T.topics(T.merge_reviews(r, b, "Toronto"), 3.0, k=2, seed=1)
    assert sorted(set(x.segment for x in dist.collect())) == ["high", "low"]
    for x in dist.collect():
        assert abs(sum(x.topic_distribution) - 1) < 1e-6
    rows = T.topic_rows(dist)
    assert rows.count() == 2 * dist.count()
    assert all(len(x.topic_word) > 0 for x in words.collect())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["b1", "b2", "b3"]), st.text("abcde", min_size=1, max_size=3),
                          st.integers(1, 5)), min_size=1, max_size=60), st.integers(1, 20), st.integers(1, 7))
def test_vocabulary_matches_brute_force(spark, rows, k, per_range):
    agg = {}
    for b, t, n in rows:
        agg[(b, t)] = agg.get((b, t), 0) + n
    tf = spark.createDataFrame([(b, t, n) for (b, t), n in agg.items()], "BusinessID string, term string, tf long")
    ttf, df = {}, {}
    for (b, t), n in agg.items():
        ttf[t] = ttf.get(t, 0) + n
        df[t] = df.get(t, 0) + 1
    expect = sorted(ttf, key=lambda t: (-ttf[t], t))[:k]
    # a small range size spreads the terms over several range partitions
    got = sorted(T.vocabulary(tf, k, terms_per_range=per_range).collect(), key=lambda r: r.idx)
    assert [r.term for r in got] == expect
    assert [r.idx for r in got] == list(range(len(expect)))
    assert all(r.df == df[r.term] for r in got)


def test_document_without_terms_has_an_even_mixture(spark):
    b = spark.createDataFrame([("b1", "B", "Toronto", "M", 0.0, 0.0, 5.0),
                               ("b2", "C", "Toronto", "M", 0.0, 0.0, 1.0)], BIZ)
    r = spark.createDataFrame([("1", "b1", "tasty noodles"), ("2", "b2", "the and of")], REV)
    merged = T.merge_reviews(r, b, "Toronto")
    terms = {(x.group, x.doc, x.term): x.weight for x in T.segment_terms(merged).collect()}
    # idf counts both documents: ln((2 + 1) / (1 + 1))
    assert set(terms) == {("high", "b1", "tasty"), ("high", "b1", "noodles")}
    assert all(abs(w - math.log(1.5)) < 1e-12 for w in terms.values())
    dist = {x.BusinessID: x for x in T.topics(merged, k=3)[1].collect()}
    assert dist["b2"].topic_distribution == [1 / 3] * 3 and dist["b2"].segment == "low"
