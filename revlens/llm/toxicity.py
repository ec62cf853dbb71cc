"""Counterfactually regularised toxicity classifier.

A logistic regression over a document's words and word beginnings (hashed).
For every labelled sentence that names a group of people a counterfactual is
made by swapping the group term for another of its list, and the squared change
of the score is added to the loss (counterfactual logit pairing, Garg et al.,
AIES 2019). A group term that happens to be frequent in toxic sentences then
gets no weight of its own, and neutral mentions are not flagged.

Fitted on a bounded sample (``MOST_DOCS`` labelled documents, the first by
hashed id): features are counted over the sample by Spark, the strongest
``MOST_FEATURES`` by likelihood ratio are kept, and ``SHARDS`` shards are fitted
and averaged. Every document is scored, over its whole text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm import textops as X
from revlens.llm.samples import labelled_sample

MOST_DOCS = 12_000
MOST_FEATURES = 4096
#: Likelihood ratio (G) below which a feature is not distinguishable from chance
#: among the hashed features.
LEAST_RATIO = 20.0
SHARDS = 4
STEPS = 300
SLOTS = 1 << 20
#: Besides whole words, beginnings of so many UTF-8 bytes.
BEGINNINGS = (5, 7)

# Group terms by language; a term is swapped for the next of its list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"), ("deaf", "blind", "disabled", "elderly", "young"),
    ("femmes", "hommes", "filles"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés", "étrangers"),
    ("frauen", "männer", "mädchen"), ("muslime", "christen", "juden"), ("einwanderer", "flüchtlinge", "ausländer"),
    ("mujeres", "hombres", "niñas"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados", "extranjeros"),
)
_SENTENCE = re.compile(r"[^.!?\n]+")


def _features(block: X.Block) -> tuple[np.ndarray, np.ndarray]:
    """Document index in the block and feature slot of every occurrence."""
    doc = np.repeat(np.arange(len(block.at) - 1), np.diff(block.at))
    docs, slots = [doc], [block.h]
    for n in BEGINNINGS:
        longer = np.flatnonzero(block.ends - block.starts > n)
        a = block.starts[longer]
        docs.append(doc[longer])
        slots.append(X.hash_words(block.buf, a, a + n) + X.GRAM[51 + n])
    return np.concatenate(docs), (X.mix(np.concatenate(slots)) % np.uint64(SLOTS)).astype(np.int64)


def _lower(col) -> list[bytes]:
    return [(t or "").lower().encode() for t in col.to_pylist()]


def _blocks(texts: list[bytes]):
    return X.blocks(texts, blank=X.NOT_LETTER)


def _count(batches):
    """Documents of each class that have a feature, by slot."""
    found = np.zeros((2, SLOTS), np.int64)
    for batch in X.small(batches):
        y = batch.column("y").to_numpy()
        for block in _blocks(_lower(batch.column("text"))):
            doc, slot = _features(block)
            pair = np.unique(doc * SLOTS + slot)
            label = y[block.rows.start:block.rows.stop][pair // SLOTS]
            for k in (0, 1):
                found[k] += np.bincount(pair[label == k] % SLOTS, minlength=SLOTS)
    at = np.flatnonzero(found.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[0, at]), pa.array(found[1, at])],
                                     names=["slot", "n0", "n1"])


def swapped(sentence: str, terms=IDENTITY_TERMS) -> str | None:
    """The sentence in lower case with every group term replaced by the next of
    its list; None when it has none."""
    after = {t: g[(i + 1) % len(g)] for g in terms for i, t in enumerate(g)}
    low = sentence.lower()
    out = re.sub(r"[^\W\d_]+", lambda m: after.get(m[0], m[0]), low)
    return out if out != low else None


class Model:
    """Feature slots, their weights and the bias."""

    def __init__(self, slots, weights, bias: float):
        self.slots, self.weights, self.bias = np.asarray(slots, np.int64), np.asarray(weights, float), float(bias)

    def index(self) -> np.ndarray:
        at = np.full(SLOTS, -1, np.int64)
        at[self.slots] = np.arange(len(self.slots))
        return at


def _vectors(texts: list[bytes], index: np.ndarray, k: int):
    """(document, feature, log(1 + count)) of every feature present."""
    for block in _blocks(texts):
        doc, slot = _features(block)
        f = index[slot]
        has = f >= 0
        pair, n = np.unique(doc[has] * max(k, 1) + f[has], return_counts=True)
        yield block.rows.start + pair // max(k, 1), pair % max(k, 1), np.log1p(n)


def _dense(texts: list[bytes], index: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((len(texts), k), np.float32)
    for d, f, v in _vectors(texts, index, k):
        out[d, f] = v
    return out


def fit(x: np.ndarray, y: np.ndarray, change: np.ndarray, fairness: float, steps: int = STEPS):
    """Logistic regression by Adam; ``change`` holds the feature change of every
    counterfactual. Returns weights and bias."""
    n, k = x.shape
    w, b = np.zeros(k), np.log((y.sum() + 1) / (n - y.sum() + 1))
    theta = np.r_[w, b]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ theta[:-1] + theta[-1], -30, 30)))
        g = np.r_[x.T @ (p - y), (p - y).sum()] / n
        g[:-1] += 1e-4 * theta[:-1]
        if len(change):
            g[:-1] += 2 * fairness * (change.T @ (change @ theta[:-1])) / len(change)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return theta[:-1], theta[-1]


def _train(slots: np.ndarray, fairness: float, terms):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        raw, y = table.column("text").to_pylist(), table.column("y").to_numpy().astype(float)
        model = Model(slots, np.zeros(len(slots)), 0)
        index, k = model.index(), len(slots)
        named = [(s, o) for t in raw for s in _SENTENCE.findall(t or "") if (o := swapped(s, terms))]
        change = _dense([s.lower().encode() for s, _ in named], index, k) - _dense(
            [o.encode() for _, o in named], index, k) if named else np.zeros((0, k))
        w, b = fit(_dense([(t or "").lower().encode() for t in raw], index, k).astype(float), y,
                   change[np.any(change, 1)], fairness)
        return pa.table({"weights": pa.array([w.tolist()], pa.list_(pa.float64())), "bias": [float(b)],
                         "n": pa.array([len(raw)], pa.int64())})
    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, most: int = MOST_DOCS,
                 fairness: float = 10.0, terms=IDENTITY_TERMS) -> Model:
    """Fit on labelled documents. ``fairness`` weighs the counterfactual term.
    Without labelled documents the model has no features and scores 0.5."""
    sample = labelled_sample(docs, labels, "toxic", usable, most)
    counts = sample.select("y", "text").mapInArrow(_count, "slot long, n0 long, n1 long").groupBy("slot").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    total = sample.agg(F.expr("count_if(y = 0)"), F.expr("count_if(y = 1)")).first()
    if not total[0] + total[1]:
        return Model([], [], 0)

    def part(n, all_n):  # n log(n / expected), 0 for n = 0
        expected = (F.col("n0") + F.col("n1")) * all_n / float(total[0] + total[1])
        return F.when(n > 0, n * F.log(n / F.greatest(expected, F.lit(1e-9)))).otherwise(0.0)

    ratio = 2 * (part(F.col("n0"), total[0]) + part(F.col("n1"), total[1]))
    best = counts.select("slot", ratio.alias("r")).where(F.col("r") >= LEAST_RATIO).orderBy(
        F.desc("r"), "slot").limit(MOST_FEATURES).collect()
    slots = np.sort(np.array([r.slot for r in best], np.int64))
    rows = (sample.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(SHARDS)))
            .groupBy("shard").applyInArrow(_train(slots, fairness, terms), "weights array<double>, bias double, n long")
            .collect())
    share = [r.n for r in rows]
    return Model(slots, np.average([r.weights for r in rows], axis=0, weights=share) if len(slots) else [],
                 np.average([r.bias for r in rows], weights=share))


def _score(model: Model):
    def run(batches):
        index, k = model.index(), len(model.slots)
        for batch in X.small(batches):
            texts = _lower(batch.column("text"))
            s, n = np.full(len(texts), model.bias), np.zeros(len(texts), np.int64)
            for d, f, v in _vectors(texts, index, k):
                s += np.bincount(d, model.weights[f] * v, len(texts)) if len(d) else 0
                n += np.bincount(d, minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(s, -30, 30)))), pa.array(n)],
                names=["doc_id", "score", "n_features"])
    return run


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1, higher is more toxic) and n_features (distinct
    model features present) for every row of ``docs`` (doc_id, text; other
    columns are ignored). Null and empty texts get the score of the bias."""
    return docs.select("doc_id", "text").mapInArrow(_score(model), "doc_id long, score double, n_features long")
