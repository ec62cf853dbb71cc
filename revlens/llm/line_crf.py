"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. A line's features are its own shape (length, symbols,
capitals, digits, repeated words, repetition of an earlier line) and the same
shape of the lines before and after it; two transition weights say how readily
a line keeps its neighbour's label. Forward-backward gives every line's
marginal probability of being good, and a document's score is the mean of these
weighted by line length.

Labels exist for documents only, so in training every line carries its
document's label. The field is fitted on a bounded sample (``MOST_DOCS``
labelled documents, the first by hashed id) in ``SHARDS`` shards whose weights
are averaged (one-shot parameter averaging, Zinkevich et al. 2010); every
document is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm import textops as X
from revlens.llm.samples import labelled_sample

#: Labelled documents to fit on, at most.
MOST_DOCS = 6000
#: Fixed, so that the weights do not depend on the cluster.
SHARDS = 4
STEPS = 150
#: A training chain is cut after so many lines; scoring runs whole documents.
CHAIN = 64

_CLASSES = {"symbol": b"#*$%&|<>^~=_@+{}[]\\/", "upper": bytes(range(65, 91)), "digit": b"0123456789",
            "bang": b"!?", "bar": b"|"}
_LUT = {k: np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(v, np.uint8)).astype(np.int32)
        for k, v in _CLASSES.items()}
_SHARED = 9  # leading features that neighbours also see
N_FEATURES = _SHARED * 3 + 6


class Lines:
    """Features (n, N_FEATURES), byte lengths and document offsets of the lines of a block."""

    def __init__(self, block: X.Block, texts: list[bytes]):
        buf = np.frombuffer(block.raw + b"\n", np.uint8)
        ends = np.flatnonzero(buf == 10)
        starts = np.r_[0, ends[:-1] + 1]
        self.length = ends - starts
        size = np.maximum(self.length, 1)
        self.at = np.cumsum([0] + [t.count(b"\n") + 1 for t in texts])
        n = len(starts)
        share = {k: np.add.reduceat(lut[buf], starts) / size for k, lut in _LUT.items()}
        line = np.searchsorted(starts, block.starts, "right") - 1  # of each word
        words = np.bincount(line, minlength=n)
        some = np.maximum(words, 1)
        h = block.h
        again = np.r_[False, (h[1:] == h[:-1]) & (line[1:] == line[:-1])] if len(h) else np.zeros(0, bool)
        _, first = np.unique(h + line.astype(np.uint64) * X.GRAM[50], return_index=True)
        distinct = np.bincount(line[first], minlength=n) if len(first) else np.zeros(n)
        repeated = np.zeros(n)
        for a, t in zip(self.at, texts):
            seen: set[bytes] = set()
            for k, x in enumerate(t.split(b"\n")):
                if x in seen:
                    repeated[a + k] = 1
                elif x:
                    seen.add(x)
        own = np.stack([share["symbol"], share["upper"], share["digit"], share["bang"], share["bar"],
                        np.bincount(line, again, n) / some, (words > 0) - distinct / some, repeated,
                        np.log1p(self.length) / 8], 1)
        opens = np.zeros(n, bool)
        opens[self.at[:-1]] = True
        closes = np.r_[opens[1:], True]
        before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
        before[opens] = 0
        after[closes] = 0
        last = buf[np.maximum(ends - 1, 0)]
        more = np.stack([np.ones(n), opens, closes, np.isin(last, [33, 46, 63]) & (self.length > 0),
                         self.length / some / 16, words < 3], 1)
        self.x = np.concatenate([own, before, after, more], 1)


def chain(score: np.ndarray, at: np.ndarray, stay: np.ndarray):
    """Forward-backward over many chains at once.

    ``score``: log-odds of good per line; ``at``: offsets of the chains;
    ``stay``: log weights of good-good and bad-bad (changes weigh 0). Returns
    the odds of good given the lines up to and with each one, and given those
    after it; their product gives the marginal.
    """
    good, bad = np.exp(stay)
    n = np.diff(at)
    order = np.argsort(-n, kind="stable")
    begin, n = at[:-1][order], n[order]
    push = np.exp(np.clip(score, -30, 30))
    fwd, bwd = np.ones(len(score)), np.ones(len(score))
    steps = int(n[0]) if len(n) else 0
    alive = np.searchsorted(-n, -np.arange(1, steps + 1), "right")  # chains with a line t
    for t in range(steps):
        i = begin[:alive[t]] + t
        fwd[i] = push[i] if t == 0 else np.clip(push[i] * (good * fwd[i - 1] + 1) / (fwd[i - 1] + bad), 1e-30, 1e30)
    for t in range(steps - 2, -1, -1):
        i = begin[:alive[t + 1]] + t
        r = np.clip(push[i + 1] * bwd[i + 1], 1e-30, 1e30)
        bwd[i] = (good * r + 1) / (r + bad)
    return fwd, bwd


def marginals(score: np.ndarray, at: np.ndarray, stay: np.ndarray) -> np.ndarray:
    fwd, bwd = chain(score, at, stay)
    odds = np.clip(fwd * bwd, 1e-30, 1e30)
    return odds / (1 + odds)


def fit(x: np.ndarray, at: np.ndarray, y: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Maximum conditional likelihood of the lines' labels by Adam, with a
    small L2 penalty. Returns line weights and the two stay weights."""
    theta = np.zeros(x.shape[1] + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    link = np.ones(len(x), bool)  # line t and t + 1 are neighbours
    link[at[1:] - 1] = False
    i = np.flatnonzero(link)
    seen = np.array([(y[i] * y[i + 1]).sum(), ((1 - y[i]) * (1 - y[i + 1])).sum()], float)
    for k in range(1, steps + 1):
        w, stay = theta[:-2], theta[-2:]
        s = x @ w
        fwd, bwd = chain(s, at, stay)
        odds = np.clip(fwd * bwd, 1e-30, 1e30)
        p = odds / (1 + odds)
        f, r = fwd[i], np.clip(np.exp(np.clip(s[i + 1], -30, 30)) * bwd[i + 1], 1e-30, 1e30)
        gg, bb = np.exp(stay[0]) * f * r, np.exp(stay[1])
        z = gg + bb + f + r
        grad = np.r_[x.T @ (p - y), [(gg / z).sum() - seen[0], (bb / z).sum() - seen[1]]] / len(x) + 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.2 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return theta[:-2], theta[-2:]


def _train(table: pa.Table) -> pa.Table:
    table = table.sort_by("doc_id")
    texts, y = X.text_bytes(table.column("text")), table.column("y").to_numpy()
    xs, ys, sizes = [], [], []
    for block in X.blocks(texts):
        lines = Lines(block, texts[block.rows.start:block.rows.stop])
        xs.append(lines.x)
        n = np.diff(lines.at)
        ys.append(np.repeat(y[block.rows.start:block.rows.stop], n))
        sizes += [c for k in n.tolist() for c in [CHAIN] * (k // CHAIN) + [k % CHAIN] if c]
    w, stay = fit(np.concatenate(xs), np.cumsum([0] + sizes), np.concatenate(ys).astype(float))
    return pa.table({"weights": pa.array([np.r_[w, stay].tolist()], pa.list_(pa.float64())),
                     "n": pa.array([len(texts)], pa.int64())})


def fit_quality(docs: DataFrame, labels: DataFrame, usable: Column, most: int = MOST_DOCS) -> np.ndarray:
    """Weights of the field (line weights, then two stay weights). Without
    labelled documents all are zero, which scores every text 0.5."""
    rows = (labelled_sample(docs, labels, "quality", usable, most)
            .withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(SHARDS)))
            .groupBy("shard").applyInArrow(lambda t: _train(t), "weights array<double>, n long").collect())
    if not rows:
        return np.zeros(N_FEATURES + 2)
    return np.average([r.weights for r in rows], axis=0, weights=[r.n for r in rows])


def _scores(texts: list[bytes], theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, lines and good lines of each text."""
    w, stay = theta[:-2], theta[-2:]
    out = []
    for block in X.blocks(texts):
        lines = Lines(block, texts[block.rows.start:block.rows.stop])
        p = marginals(lines.x @ w, lines.at, stay)
        size = np.add.reduceat(lines.length, lines.at[:-1])
        mean = np.add.reduceat(p * lines.length, lines.at[:-1]) / np.maximum(size, 1)
        out.append((np.clip(np.where(size > 0, mean, p[lines.at[:-1]]), 0, 1), np.diff(lines.at),
                    np.add.reduceat((p >= 0.5).astype(np.int64), lines.at[:-1])))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.empty(0), *[np.empty(0, np.int64)] * 2)


def score_quality(docs: DataFrame, theta: np.ndarray) -> DataFrame:
    """doc_id, score (0 to 1, higher is better), n_lines, n_good_lines for every
    row of ``docs`` (doc_id, text; other columns are ignored). Null text counts
    as empty: one empty line, whose own marginal is the score."""
    def run(batches):
        for batch in X.small(batches):
            score, n, good = _scores(X.text_bytes(batch.column("text")), theta)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array(n, pa.int64()), pa.array(good, pa.int64())],
                names=["doc_id", "score", "n_lines", "n_good_lines"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_lines long, n_good_lines long")


def keep_good(docs: DataFrame, theta: np.ndarray, least: float) -> DataFrame:
    """Rows of ``docs``, all their columns, whose score is at least ``least``."""
    def run(batches):
        for batch in X.small(batches):
            score = _scores(X.text_bytes(batch.column("text")), theta)[0]
            yield batch.filter(pa.array(score >= least))
    return docs.mapInArrow(run, docs.schema)
