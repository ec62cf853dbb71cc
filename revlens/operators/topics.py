"""Latent Dirichlet allocation whose model is a table.

Variational Bayes by coordinate ascent (Blei, Ng, Jordan 2003; Hoffman, Blei, Bach
2010) in the form of joins and grouped sums. Rows are (group, doc, term, weight);
each group (a rating segment) is fitted on its own, all groups in the same jobs.

* The state is two tables: k variational parameters of each (group, term) and of
  each document. Neither passes through the driver, nor is any vocabulary cut; the
  driver sees k totals and one bound a group.
* The rows are dealt by (group, term) and sorted once. An iteration deals the terms'
  parameters alike, joins the rows with both tables, shares each weight among the
  topics, and sums the shares by document (combined map-side) and by term (in place:
  the rows are not shuffled again). The sums are written, so a lost executor costs one
  iteration and its part of the dealt rows.
* Digamma and log-gamma are arithmetic column expressions, of one row of a term or
  document each, never of a row of the join; k parameters are k columns.

The bound never falls from one iteration to the next (tested); the fit stops when
it rises by less than ``tolerance`` of itself.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.sources.io import persist_cut

_SHIFT = 6
#: Rows (group, doc, term) of a partition, at most about.
ROWS_PER_PART = 1_000_000


def digamma(x: Column) -> Column:
    """Derivative of log-gamma for x > 0, to 1e-9: recurrence up to x + 6, then the
    asymptotic series."""
    y = x + _SHIFT
    z = 1 / (y * y)
    series = F.log(y) - 1 / (2 * y) - z * (F.lit(1 / 12) - z * (F.lit(1 / 120) - z * (F.lit(1 / 252) - z * F.lit(1 / 240))))
    return series - reduce(add, [1 / (x + i) for i in range(_SHIFT)])


def lgamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0, to 1e-9."""
    y = x + _SHIFT
    z = 1 / (y * y)
    series = (y - 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + (
        F.lit(1 / 12) - z * (F.lit(1 / 360) - z * (F.lit(1 / 1260) - z * F.lit(1 / 1680)))) / y
    return series - F.log(reduce(lambda a, b: a * b, [x + i for i in range(_SHIFT)]))


def _all(k: int, prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(k)]


def _sum(cols) -> Column:
    return reduce(add, [F.col(c) if isinstance(c, str) else c for c in cols])


def _digammas(names: list[str]) -> Column:
    """Array of the digammas of some columns. A lambda over an array keeps the generated
    code short: a method with k digammas written out is too long for the JIT compiler,
    and each row then costs some fifty times as much."""
    return F.transform(F.array(*names), digamma)


def _theta(mixtures: DataFrame, k: int) -> DataFrame:
    """(doc, t0..): exponentials of the expected log shares of a document's topics."""
    m = mixtures.withColumn("_all", _sum(_all(k, "g"))).select("doc", _digammas([*_all(k, "g"), "_all"]).alias("_d"))
    return m.select("doc", *[F.exp(F.col("_d")[i] - F.col("_d")[k]).alias(f"t{i}") for i in range(k)])


def _totals(model: DataFrame, k: int) -> DataFrame:
    """(group, s0.., n_terms): sums of the parameters of each topic, one row a group."""
    return model.groupBy("group").agg(*[F.sum(f"l{i}").alias(f"s{i}") for i in range(k)],
                                      F.count(F.lit(1)).alias("n_terms"))


def _beta(model: DataFrame, k: int) -> DataFrame:
    """(group, term, b0..): exponentials of the expected log weights of a term."""
    totals = _totals(model, k).select("group", _digammas(_all(k, "s")).alias("_s"))
    m = model.join(F.broadcast(totals), "group")  # one row a group
    m = m.select("group", "term", _digammas(_all(k, "l")).alias("_l"), "_s")
    return m.select("group", "term", *[F.exp(F.col("_l")[i] - F.col("_s")[i]).alias(f"b{i}") for i in range(k)])


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` held by (group, term), in order: two tables so dealt are joined, and
    summed by term, without a shuffle."""
    return rows.repartition(parts, "group", "term").sortWithinPartitions("group", "term").persist()


def _shared(rows: DataFrame, beta: DataFrame, theta: DataFrame, k: int) -> DataFrame:
    """Rows with their weight shared among the topics (p0..) and their part of the
    bound (fit)."""
    j = rows.join(beta, ["group", "term"]).join(theta, "doc")
    return _shares(j, k, "group", "doc", "term", (F.col("weight") * F.log("_z")).alias("fit"))


def _shares(joined: DataFrame, k: int, *others) -> DataFrame:
    """The weight of each row shared among the topics (p0..) by its b0.. and t0..;
    ``_z`` is the sum of their products."""
    j = joined.withColumns({f"p{i}": F.col(f"b{i}") * F.col(f"t{i}") for i in range(k)}).withColumn(
        "_z", _sum(_all(k, "p"))).withColumn("_r", F.col("weight") / F.col("_z"))
    return j.select(*others, *[(F.col("_r") * F.col(f"p{i}")).alias(f"p{i}") for i in range(k)])


def _bound(docs: DataFrame, mixtures: DataFrame, model: DataFrame, k: int, alpha: float, eta: float) -> float:
    """Variational bound at the parameters ``mixtures`` and ``model``; ``docs``
    holds the fit of each document under them. One job."""
    def added(parts):
        return F.aggregate(parts, F.lit(0.0), add)

    m = mixtures.withColumn("_s", _sum(_all(k, "g"))).withColumn("_d", digamma(F.col("_s")))
    doc = F.lit(math.lgamma(k * alpha) - k * math.lgamma(alpha)) - lgamma(F.col("_s")) + added(
        F.transform(F.array(*_all(k, "g")), lambda g: lgamma(g) + (alpha - g) * (digamma(g) - F.col("_d"))))
    totals = _totals(model, k)
    term = added(F.zip_with(F.array(*_all(k, "l")), F.col("_s"), lambda x, s: lgamma(x) - F.lit(math.lgamma(eta))
                            + (eta - x) * (digamma(x) - s)))
    whole = _sum([lgamma(F.col("n_terms") * F.lit(float(eta))) - lgamma(F.col(f"s{i}")) for i in range(k)])
    each = model.join(F.broadcast(totals.select("group", _digammas(_all(k, "s")).alias("_s"))), "group")
    parts = [docs.agg(F.sum("fit").alias("x")), m.agg(F.sum(doc).alias("x")),
             each.agg(F.sum(term).alias("x")), totals.agg(F.sum(whole).alias("x"))]
    return reduce(DataFrame.unionByName, parts).agg(F.sum("x")).first()[0] or 0.0


def _sums(k: int, *others: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in (*_all(k, "p"), *others)]


def _start(rows: DataFrame, k: int, seed: int) -> DataFrame:
    """First shares: half of a document's weight to a topic drawn by hash of its id,
    the rest evenly. Same at every partitioning."""
    own = F.pmod(F.xxhash64("doc", F.lit(seed)), F.lit(k))
    return rows.groupBy("group", "term").agg(*[
        F.sum(F.col("weight") * (F.lit(0.5 / k) + F.when(own == i, 0.5).otherwise(0.0))).alias(f"p{i}") for i in range(k)])


def fit_topics(rows: DataFrame, k: int = 6, seed: int = 123, max_iter: int = 20, tolerance: float = 1e-4,
               check_every: int = 5, alpha: float | None = None,
               eta: float | None = None) -> tuple[DataFrame, list[float]]:
    """Fit ``k`` topics to every group of ``rows`` (group, doc, term, weight >= 0).

    A document belongs to one group; (doc, term) rows of a document are its bag of
    words. Rows of weight 0 or null say nothing. Returns the model, a written table
    (group, term, l0..l<k-1>, the Dirichlet parameters of each topic), and the bound
    before every ``check_every``-th iteration, where the fit may stop. ``alpha`` and ``eta`` are 1/k unless given. No rows give
    an empty model.
    """
    alpha, eta = alpha or 1 / k, eta or 1 / k
    spark = rows.sparkSession
    rows = persist_cut(rows.where("weight > 0").select("group", "doc", "term", F.col("weight").cast("double")),
                       spark, "topic-rows")

    def model_of(terms):
        return persist_cut(terms.select("group", "term", *[(F.col(f"p{i}") + eta).alias(f"l{i}") for i in range(k)]),
                           spark, "topic-model")

    model = model_of(_start(rows, k, seed))
    flat = rows.groupBy("doc").agg(F.sum("weight").alias("w"))
    mixtures = persist_cut(flat.select("doc", *[(F.col("w") / k + alpha).alias(f"g{i}") for i in range(k)]),
                           spark, "topic-mixtures")
    parts = max(spark.sparkContext.defaultParallelism, rows.count() // ROWS_PER_PART + 1)
    rows = _dealt(rows, parts)
    bounds: list[float] = []
    for i in range(max_iter):
        beta = _dealt(_beta(model, k), parts)
        got = _shared(rows, beta, _theta(mixtures, k), k)
        docs = persist_cut(got.groupBy("doc").agg(*_sums(k, "fit")), spark, "topic-docs")
        if i % check_every == 0:
            bounds.append(_bound(docs, mixtures, model, k, alpha, eta))
        model = model_of(got.groupBy("group", "term").agg(*_sums(k)))
        beta.unpersist()
        mixtures = docs.select("doc", *[(F.col(f"p{i}") + alpha).alias(f"g{i}") for i in range(k)])
        if i % check_every == 0 and len(bounds) > 1 and bounds[-1] - bounds[-2] <= tolerance * abs(bounds[-1]):
            break
    rows.unpersist()
    return model, bounds


def columns(k: int) -> str:
    """Schema of a model of ``k`` topics, to read it back."""
    return "group string, term string, " + ", ".join(f"l{i} double" for i in range(k))


def n_topics(model: DataFrame) -> int:
    return sum(c[:1] == "l" and c[1:].isdigit() for c in model.columns)


def infer(model: DataFrame, rows: DataFrame, iterations: int = 10, alpha: float | None = None) -> DataFrame:
    """Mixtures of documents under a fitted model: (doc, topics array<double>).

    ``rows`` (group, doc, term, weight) need not be those of the fit. Terms that
    the model does not know say nothing; a document without known terms has no row.
    """
    k = n_topics(model)
    alpha = alpha or 1 / k
    spark = model.sparkSession
    known = persist_cut(rows.where("weight > 0").select("group", "doc", "term", F.col("weight").cast("double"))
                        .join(_beta(model, k), ["group", "term"]).drop("group", "term"), spark, "topic-known")
    mixtures = known.groupBy("doc").agg(F.sum("weight").alias("w")).select(
        "doc", *[(F.col("w") / k + alpha).alias(f"g{i}") for i in range(k)])
    for _ in range(iterations):
        got = _shares(known.join(_theta(mixtures, k), "doc"), k, "doc").groupBy("doc").agg(*_sums(k))
        mixtures = persist_cut(got.select("doc", *[(F.col(f"p{i}") + alpha).alias(f"g{i}") for i in range(k)]),
                               spark, "topic-mixtures")
    whole = _sum(_all(k, "g"))
    return mixtures.select("doc", F.array(*[F.col(f"g{i}") / whole for i in range(k)]).alias("topics"))


def top_terms(model: DataFrame, max_terms: int = 10) -> DataFrame:
    """(group, topic, terms): the terms of largest expected weight of each topic,
    ties by term. Each task keeps at most ``max_terms`` of a topic before the
    shuffle."""
    k = n_topics(model)
    each = model.select("group", "term", F.posexplode(F.array(*_all(k, "l"))).alias("topic", "w"))
    by = Window.partitionBy("group", "topic").orderBy(F.desc("w"), "term")
    best = each.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= max_terms)
    g = best.groupBy("group", "topic").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("t"))
    return g.select("group", "topic", F.col("t.term").alias("terms"))
