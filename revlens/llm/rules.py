"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target
and the raw corpus, JVM built-ins only.

Words and pairs of words are hashed into ``SLOTS`` slots. Two multinomials over
the slots are counted, one over the whole raw corpus, one over the trusted
target; a slot's weight is the log of their smoothed ratio. A document's score
is the mean weight of its words and word pairs, so it does not grow with length,
and the document is kept when the score reaches a fixed threshold.

Both are counted whole, in one pass over the corpus that marks the trusted
documents. Their ids are broadcast when few enough (then no text is shuffled);
beyond that the same join shuffles. The weights (``SLOTS`` doubles) enter the
scoring plan as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm import native as N
from revlens.sources.io import persist_cut

SLOTS = 1 << 16
#: Trusted ids up to which they are broadcast (16 bytes each).
BROADCAST_IDS = 500_000
#: Score from which a document is kept. Text like the target scores about 0;
#: a document of which a good part is text that trusted documents lack falls
#: far below.
LEAST_SCORE = -0.1
#: Added to every count: a slot met once or twice tells little either way.
SMOOTHING = 8.0
SYMBOLS = "#*$%&|<>"


def _hashed(docs: DataFrame, *more: Column) -> DataFrame:
    """Columns ``more`` (which may use ``v``, a text's words) beside ``w`` and
    ``p``, the hashes of its words and of its pairs of neighbouring words. Each
    array is a column of its own: it is made once, and all but the lambdas over
    it is compiled."""
    worded = docs.withColumn("v", F.expr(N.words("text")))
    return worded.select(*more, F.expr(N.hashes("v")).alias("w")).withColumn("p", F.expr(N.runs("w")))


def _mean_weight() -> Column:
    """Mean weight of the words ``w`` and word pairs ``p``, added in text order.
    ``weights`` and ``n_grams`` are read once, so that the optimizer can put in
    what they stand for: no row then holds the weights."""
    def total(weights: Column) -> Column:
        def weight(h: Column) -> Column:
            return F.get(weights, h.bitwiseAND(F.lit(SLOTS - 1)))

        return F.aggregate(F.arrays_zip(F.slice("w", 1, F.size("p")).alias("w"), "p"), F.lit(0.0),
                           lambda a, x: a + weight(x["w"]) + weight(x["p"]),
                           lambda a: a + weight(F.get("w", F.size("p"))))

    return F.coalesce(F.try_divide(F.transform(F.array("weights"), total)[0], "n_grams"), F.lit(0.0))


def slot_weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row: ``weights``, the log ratio of every slot. ``trusted``: doc_id."""
    spark = docs.sparkSession
    ids = persist_cut(trusted.where("doc_id IS NOT NULL").select("doc_id").distinct(), spark, "trusted")
    ids, few = ids.withColumn("trusted", F.lit(True)), ids.count() <= BROADCAST_IDS
    marked = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id", "left")
    grams = _hashed(marked, F.col("trusted")).select("trusted", F.explode(F.concat("w", "p")).alias("h"))
    slot = F.col("h").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")
    met = grams.select("trusted", slot).groupBy("slot").agg(F.count(F.lit(1)).alias("r"), F.count("trusted").alias("t"))
    both = spark.range(SLOTS).select(F.col("id").cast("int").alias("slot")).join(met, "slot", "left").select(
        "slot", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("t", F.lit(0)).alias("t"))
    both = persist_cut(both, spark, "slots")
    total = both.agg(F.sum("r").alias("nr"), F.sum("t").alias("nt"))
    # The target's counts are scaled to the corpus, so a target that is like it weighs 0.
    scaled = F.col("t") * (F.col("nr") / F.col("nt"))
    weight = F.when(F.col("nt") > 0, F.log((scaled + SMOOTHING) / (F.col("r") + SMOOTHING))).otherwise(0.0)
    return both.join(F.broadcast(total)).select(F.struct("slot", weight.alias("w")).alias("x")).agg(
        F.array_sort(F.collect_list("x")).alias("x")).select(F.col("x.w").alias("weights"))


def quality_rules(docs: DataFrame, trusted: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Base rules and the likelihood-ratio verdict on every row of ``docs``
    (doc_id, text; other columns are ignored). ``trusted``: doc_id of trusted
    documents.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long), base_failed, kept (boolean), score (double). Null and empty texts
    have no words: they fail the base rules and score 0. Without trusted
    documents every score is 0.
    """
    weights = persist_cut(slot_weights(docs, trusted), docs.sparkSession, "weights").scalar()
    text = "coalesce(text, '')"
    lines = f"filter(split({text}, '\\n'), x -> NOT ({N.is_blank('x')}))"
    counts = ("word_chars", "n_symbols", "n_dup_lines")
    rows = _hashed(
        docs.select("doc_id", "text"), F.col("doc_id"),
        F.expr("cast(char_length(concat_ws('', v)) as bigint)").alias("word_chars"),
        F.expr(N.count_chars(text, SYMBOLS)).alias("n_symbols"),
        F.expr(N.let("l", lines, "cast(size(l) - size(array_distinct(l)) as bigint)")).alias("n_dup_lines"))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), *counts, "w", "p",
                       (F.size("w") + F.size("p")).alias("n_grams"), weights.alias("weights"))
    counts = ("doc_id", "n_words", *counts, "score")
    rows = rows.withColumn("score", _mean_weight()).select(*counts, F.expr(N.runs("p")).alias("q"))
    rows = rows.select(*counts, F.expr(N.sorted_places("q")).alias("s"))
    rows = rows.select(*counts, F.expr(N.covered("s")).alias("n_repeat_words"))
    failed: Column = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & (F.col("score") >= least)).alias("kept"), "score")
