"""Benchmark decontamination by size-partitioned MinHash containment search
(after LSH Ensemble, Zhu et al., VLDB 2016), verified by exact containment.

An item is found in a document when at least ``percent`` of the item's distinct
5-word shingles are among the document's. MinHash estimates Jaccard similarity,
which a short item and a long document never have, so sizes are partitioned:

* Items of one size class (sizes in (s/2, s], s = 8, 16, 32 ...) are compared
  with the document's windows of that class: two neighbouring blocks of s
  consecutive shingles. An item that occurs in one piece lies inside a window
  at most four times its size, so their Jaccard similarity is bounded below.
* Item and window meet when any of ``HASHES`` minima is equal. At the lower
  bound for 80 % containment, 0.8 / 4.2, the chance to miss is 1.4e-6, for a
  whole item 1e-8.
* Every meeting is verified: the shared shingles of item and whole document
  are counted exactly.

Minima of the larger classes come from those of the smaller ones, so every
shingle is hashed once per hash function whatever the number of classes.

While the items are few (``MOST_ITEM_BYTES`` of text) they go to every task and
nothing is shuffled. Beyond that the same minima are joined by a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import textops as X
from revlens.llm.samples import without
from revlens.sources.io import persist_cut

WORDS = 5
HASHES = 64
SMALLEST = 8
#: Text of all items up to which they are sent to the tasks.
MOST_ITEM_BYTES = 16 << 20
_LUT_BITS = 16
_U = np.uint64
_ODD = np.random.Generator(np.random.PCG64(77)).integers(0, 2**64, HASHES, dtype=_U) | _U(1)


def shingles(text: bytes) -> np.ndarray:
    """Distinct 5-word shingles, sorted; none for a text of fewer words."""
    for block in X.blocks([text], lower=True):
        for _, h in block.docs():
            return np.unique(X.grams(h, WORDS))
    return np.empty(0, _U)


def size_class(n: int) -> int:
    """Number of doublings of SMALLEST until it holds n."""
    return max(0, (n - 1).bit_length() - (SMALLEST - 1).bit_length())


def item_minima(q: np.ndarray) -> np.ndarray:
    return np.array([(q * a).min() for a in _ODD], _U)


class Windows:
    """Window minima of the documents of a block, class by class."""

    def __init__(self, block: X.Block):
        n = np.maximum(np.diff(block.at) - WORDS + 1, 0)  # shingles of each text
        g = X.grams(block.h, WORDS)
        keep = np.zeros(len(g) + 1, np.int64)
        np.add.at(keep, block.at[:-1][n > 0], 1)
        np.add.at(keep, (block.at[:-1] + n)[n > 0], -1)
        self.g = g[np.cumsum(keep)[:-1] > 0]
        self.at = np.cumsum(np.r_[0, n])
        per = -(-n // SMALLEST)
        first = np.repeat(np.cumsum(np.r_[0, per[:-1]]), per)
        self.doc = np.repeat(np.arange(len(n)), per)
        self.local = np.arange(len(first)) - first
        self.start = np.repeat(self.at[:-1], per) + SMALLEST * self.local

    def minima(self, hash_no: int, classes: int):
        """(class, document, minimum) arrays of all windows under one hash."""
        if not len(self.start):
            return
        m = np.minimum.reduceat(self.g * _ODD[hash_no], self.start)
        doc, local = self.doc, self.local
        for c in range(classes):
            window = m.copy()
            same = np.flatnonzero(doc[1:] == doc[:-1])
            window[same] = np.minimum(m[same], m[same + 1])
            yield c, doc, window
            even = np.flatnonzero(local % 2 == 0)
            m, doc, local = np.minimum.reduceat(m, even), doc[even], local[even] // 2

    def of(self, doc: int) -> np.ndarray:
        return self.g[self.at[doc]:self.at[doc + 1]]


class Items:
    """Minima of a bounded set of items, by size class and hash."""

    def __init__(self, ids: list[int], texts: list[bytes]):
        both = [(i, q) for i, t in zip(ids, texts) if len(q := shingles(t))]
        self.ids, self.sets = [i for i, _ in both], [q for _, q in both]
        cls = np.array([size_class(len(q)) for q in self.sets], np.int64)
        self.classes = int(cls.max()) + 1 if len(cls) else 0
        mins = np.array([item_minima(q) for q in self.sets]).reshape(-1, HASHES)
        self.by_class = {}
        for c in range(self.classes):
            who = np.flatnonzero(cls == c)
            order = np.argsort(mins[who], 0, kind="stable")
            self.by_class[c] = np.take_along_axis(mins[who], order, 0), who[order]

    def lookup(self) -> dict:
        """Per class and hash: which low bits of a minimum can be an item's."""
        out = {}
        for c, (values, _) in self.by_class.items():
            table = np.zeros((HASHES, 1 << _LUT_BITS), bool)
            low = (values & _U((1 << _LUT_BITS) - 1)).astype(np.int64)
            table[np.arange(HASHES)[None, :], low] = True
            out[c] = table
        return out

    def meetings(self, w: Windows, table: dict) -> set[tuple[int, int]]:
        """(document, item) pairs with an equal minimum."""
        found: set[tuple[int, int]] = set()
        for j in range(HASHES):
            for c, doc, m in w.minima(j, self.classes):
                values, who = self.by_class[c]
                if not len(values):
                    continue
                at = np.flatnonzero(table[c][j][(m & _U((1 << _LUT_BITS) - 1)).astype(np.int64)])
                left = np.searchsorted(values[:, j], m[at], "left")
                right = np.searchsorted(values[:, j], m[at], "right")
                for k in np.flatnonzero(right > left):
                    found.update((int(doc[at[k]]), int(i)) for i in who[left[k]:right[k], j])
        return found


def _contained(q: np.ndarray, g: np.ndarray) -> int:
    return int(np.isin(q, g).sum())


_OUT = "doc_id long, item_id long, n_item long, n_found long"


def _rows(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                      names=["doc_id", "item_id", "n_item", "n_found"])


def _search(items: Items, percent: int):
    def run(batches):
        table = items.lookup()
        for batch in X.small(batches):
            ids = batch.column("doc_id").to_pylist()
            rows = []
            for block in X.blocks(X.text_bytes(batch.column("text")), lower=True):
                w = Windows(block)
                for doc, item in sorted(items.meetings(w, table)):
                    n = _contained(items.sets[item], w.of(doc))
                    if 100 * n >= percent * len(items.sets[item]):
                        rows.append((ids[block.rows[doc]], items.ids[item], len(items.sets[item]), n))
            yield _rows(rows)
    return run


def _key(c: int, j: int, m: np.ndarray) -> np.ndarray:
    return X.mix(m + X.GRAM[60] * np.array([c * HASHES + j + 1], _U)).view(np.int64)


def _window_keys(classes: int):
    def run(batches):
        for batch in X.small(batches):
            ids = batch.column("doc_id").to_numpy()
            for block in X.blocks(X.text_bytes(batch.column("text")), lower=True):
                w = Windows(block)
                for j in range(HASHES):
                    for c, doc, m in w.minima(j, classes):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(_key(c, j, m)), pa.array(ids[block.rows.start + doc])], names=["key", "doc_id"])
    return run


def _item_keys(batches):
    for batch in X.small(batches):
        keys, ids, cls = [], [], []
        for i, t in zip(batch.column("item_id").to_pylist(), X.text_bytes(batch.column("text"))):
            q = shingles(t)
            if len(q):
                c = size_class(len(q))
                keys += [int(_key(c, j, m)[0]) for j, m in enumerate(item_minima(q).reshape(-1, 1))]
                ids += [i] * HASHES
                cls += [c] * HASHES
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64()),
                                          pa.array(cls, pa.int32())], names=["key", "item_id", "class"])


def _verify(percent: int):
    def run(batches):
        for batch in X.small(batches):
            rows = []
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "item_id")]
            for d, i, t, q in zip(*cols, X.text_bytes(batch.column("text")), X.text_bytes(batch.column("item"))):
                s = shingles(q)
                n = _contained(s, shingles(t))
                if 100 * n >= percent * len(s):
                    rows.append((d, i, len(s), n))
            yield _rows(rows)
    return run


def contaminated(docs: DataFrame, items: DataFrame, percent: int = 80,
                 most_item_bytes: int = MOST_ITEM_BYTES) -> DataFrame:
    """Benchmark items found in documents.

    ``docs``: doc_id long, text; ``items``: item_id long, text; other columns
    are ignored. Returns doc_id, item_id, n_item (distinct shingles of the
    item), n_found (those in the document) with 100 * n_found >= percent *
    n_item. Words are lower-cased in A-Z. Null and blank texts, and texts of
    fewer than five words, contain nothing and are found nowhere; null ids are
    ignored. Equal items are all reported. Empty tables give an empty result.
    """
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    items = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    if size <= most_item_bytes:
        rows = items.collect()
        known = Items([r.item_id for r in rows], [r.text.encode() for r in rows])
        return docs.mapInArrow(_search(known, percent), _OUT).distinct()
    spark = docs.sparkSession
    keys = persist_cut(items.mapInArrow(_item_keys, "key long, item_id long, class int"), spark, "item-keys")
    classes = (keys.agg(F.max("class")).first()[0] or 0) + 1
    met = persist_cut(docs.mapInArrow(_window_keys(classes), "key long, doc_id long").join(keys, "key")
                      .select("doc_id", "item_id").distinct(), spark, "meetings")
    return (met.join(items.withColumnRenamed("text", "item"), "item_id").join(docs, "doc_id")
            .select("doc_id", "item_id", "text", "item").mapInArrow(_verify(percent), _OUT).distinct())


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """Rows of ``docs``, all their columns, in which no item is found. Rows with
    a null doc_id are kept: nothing can be said against them."""
    return without(docs, contaminated(docs, items, percent))
