"""Substring deduplication by seed and extend.

A window is ``width`` consecutive words. A word is removed when a window over
it also starts in a document with a smaller doc_id.

*Seed.* Winnowing (Schleimer, Wilkerson, Aiken, SIGMOD 2003): each window picks
its smallest ``seed``-word gram, the leftmost of equals. Equal windows pick
equal anchors, so only documents that share an anchor can share a window. One
anchor serves about half of ``width - seed`` windows, and a document is one row
per anchor, not per word.

*Extend.* An anchor's neighbourhood is what lies under all windows that picked
it. Documents with the same neighbourhood (128-bit digest) agree on every
window in it, to both sides: one grouped minimum decides them, with no pairs.
Neighbourhoods of one anchor that differ (the ends of a shared passage, an
edit in a copy) are extended window by window, at every place where the smallest
document of each holds it, and meet on the digests of their windows.

Overlapping windows of a document union into its maximal repeats. Grouped
minima combine map-side and come back by equi-joins that AQE can split, so an
anchor in a third of all documents is no hot task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import textops as X
from revlens.sources.io import persist_cut

#: Documents up to which texts are picked by a broadcast semi join (16 bytes each).
BROADCAST_IDS = 500_000


def anchors(h: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and last window of each neighbourhood."""
    if len(h) < width:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    g = X.grams(h, seed)
    pick = sliding_window_view(g, width - seed + 1).argmin(1) + np.arange(len(h) - width + 1)
    begin = np.flatnonzero(np.r_[True, pick[1:] != pick[:-1]])
    return g[pick[begin]].view(np.int64), begin, np.r_[begin[1:], len(pick)] - 1


class _Slices:
    """128-bit digests of word ranges of a text, its blanks made single."""

    def __init__(self, text: bytes):
        self.words = text.split()  # splits at the same six blanks
        self.flat = b" ".join(self.words)
        self.begin = np.cumsum([0] + [len(w) + 1 for w in self.words])

    def digest(self, first: int, last: int) -> bytes:
        return hashlib.blake2b(self.flat[self.begin[first]:self.begin[last] - 1], digest_size=16).digest()


def _halves(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    a = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return pa.array(np.ascontiguousarray(a[:, 0])), pa.array(np.ascontiguousarray(a[:, 1]))


def _seed(width: int, seed: int):
    def run(batches):
        for batch in X.small(batches):
            ids = batch.column("doc_id").to_numpy()
            texts = X.text_bytes(batch.column("text"))
            for block in X.blocks(texts):
                doc, anchor, first, last, digest = [], [], [], [], []
                for row, h in block.docs():
                    a, b, e = anchors(h, width, seed)
                    if len(a):
                        s = _Slices(texts[row])
                        digest += [s.digest(i, j + width) for i, j in zip(b.tolist(), e.tolist())]
                        doc.append(np.full(len(a), ids[row]))
                        anchor.append(a)
                        first.append(b)
                        last.append(e)
                if doc:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x).astype(np.int64)) for x in (doc, anchor, first, last)]
                        + list(_halves(digest)), names=["doc_id", "anchor", "first", "last", "d1", "d2"])
    return run


def _windows(width: int):
    """Texts with the neighbourhoods they represent -> one row per window."""
    def run(batches):
        for batch in X.small(batches):
            ids = batch.column("doc_id").to_numpy()
            texts = X.text_bytes(batch.column("text"))
            for row, spans in enumerate(batch.column("spans").to_pylist()):
                s = _Slices(texts[row])
                at = sorted({i for x in spans for i in range(x["first"], x["last"] + 1)})
                for k in range(0, len(at), 100_000):
                    part = at[k:k + 100_000]
                    w1, w2 = _halves([s.digest(i, i + width) for i in part])
                    yield pa.RecordBatch.from_arrays(
                        [w1, w2, pa.array(np.full(len(part), ids[row], np.int64)), pa.array(part, pa.int64())],
                        names=["w1", "w2", "doc_id", "first"])
    return run


def _cut_words(batches):
    """Texts with the word ranges to remove -> kept words joined by a blank."""
    for batch in X.small(batches):
        n, removed, kept = [], [], []
        for text, spans in zip(X.text_bytes(batch.column("text")), batch.column("spans").to_pylist()):
            words = text.split()
            step = np.zeros(len(words) + 1, np.int64)
            for x in spans or ():
                step[x["first"]] += 1
                step[x["end"]] -= 1
            gone = np.cumsum(step[:-1]) > 0
            n.append(len(words))
            removed.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def repeated_spans(docs: DataFrame, width: int = 50, seed: int = 10) -> DataFrame:
    """Word ranges (doc_id, first, end) under windows that also start in a
    document with a smaller doc_id. Ranges may overlap or repeat."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    occ = persist_cut(docs.mapInArrow(_seed(width, seed), "doc_id long, anchor long, first long, last long, "
                                                          "d1 long, d2 long"), spark, "anchors")
    shared = persist_cut(occ.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                         .where("lo < hi").select("anchor"), spark, "shared-anchors")
    occ = persist_cut(occ.join(shared, "anchor", "left_semi"), spark, "seeds")
    same = persist_cut(occ.groupBy("d1", "d2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                                   F.min("anchor").alias("anchor")), spark, "neighbourhoods")
    copies = (occ.join(same.where("lo < hi").select("d1", "d2", "lo"), ["d1", "d2"])
              .where("doc_id > lo").select("doc_id", "first", (F.col("last") + width).alias("end")))
    # Written first, so that the joins below have an exchange on both sides, which AQE can split.
    several = persist_cut(same.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"),
                          spark, "contested")
    contested = persist_cut(same.join(several, "anchor", "left_semi").select("d1", "d2", F.col("lo").alias("doc_id")),
                            spark, "representatives")
    # Every occurrence in the representing document: its repeats there are no copies, but may be met too.
    spans = persist_cut(occ.join(contested, ["d1", "d2", "doc_id"], "left_semi").groupBy("doc_id").agg(
        F.collect_set(F.struct("first", "last")).alias("spans")), spark, "extend")
    few = spans.count() <= BROADCAST_IDS
    ids = spans.select("doc_id")
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    win = persist_cut(texts.join(spans, "doc_id").select("doc_id", "text", "spans").mapInArrow(
        _windows(width), "w1 long, w2 long, doc_id long, first long"), spark, "windows")
    low = persist_cut(win.groupBy("w1", "w2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                      .where("lo < hi").drop("hi"), spark, "windows-met")
    edges = win.join(low, ["w1", "w2"]).where("doc_id > lo").select(
        "doc_id", "first", (F.col("first") + width).alias("end"))
    return copies.unionByName(edges)


def remove_repeats(docs: DataFrame, width: int = 50, seed: int = 10) -> DataFrame:
    """Documents without the words of repeated windows.

    ``docs``: doc_id long, text string; other columns are ignored. Returns
    doc_id, n_words, n_removed, kept (kept words joined by one space), one row
    per row of ``docs``. Null and blank texts keep nothing and lose nothing.
    Rows with a null doc_id take no part in the comparison and stay whole.
    Equal texts lose all windows but in the smallest doc_id. Rows that repeat a
    doc_id are one document: they are not compared with each other.
    """
    spans = repeated_spans(docs, width, seed).groupBy("doc_id").agg(
        F.collect_set(F.struct("first", "end")).alias("spans"))
    return docs.select("doc_id", "text").join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut_words, "doc_id long, n_words long, n_removed long, kept string")
