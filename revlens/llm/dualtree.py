"""Ranked lexical search of many items over all documents by dual trees.

The score of a document for an item is a sparse inner product: an item's
coordinate is its number of occurrences of a term times the term's weight, a
document's is the saturated, length-normalised term frequency. All coordinates
are non-negative integers, so sums of doubles are exact and the coordinate-wise
maxima of two groups bound every score between them (Curtin and Ram, "Dual-tree
fast exact max-kernel search", 2014).

1. *Postings.* One pass over the texts turns each document into its number of
   terms and its occurrences of the items' terms, written as a table.
2. *Statistics.* Number of documents, of terms and document frequencies are
   grouped sums over that table; only the items' terms come to the driver.
3. *Trees.* Items form one tree, which is broadcast. Each task reads documents in
   chunks of bounded size and builds a tree over each: a node is split by the term
   that tells most, and holds the maximum of every coordinate below it.
4. *Search.* A pair of nodes is left out when its bound lies under the weakest
   kth score of the items below it. Pairs of leaves are scored exactly. A task
   keeps the best ``k`` documents of an item and hands on no others.
5. *Floors.* The kth score among a hashed part of the documents is a lower bound
   of the true one. Tasks start from it, so few rows leave them. It only prunes:
   documents of that part are searched again like all others.

Items are taken in blocks of bounded size, each a search over all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm import textops as X
from revlens.sources.io import persist_cut

#: Items, and their terms with repeats, of one block; what is broadcast and held
#: by the driver is bounded by them.
BLOCK_ITEMS, BLOCK_TERMS = 2_000, 400_000
#: Documents, and their postings, of one tree.
CHUNK_DOCS, CHUNK_POSTINGS = 4096, 1_000_000
#: Items and documents in a leaf.
ITEM_LEAF, DOC_LEAF = 8, 32
#: The floors come from one in so many documents.
FLOOR_PART = 32
#: Sums of coordinates stay exact in doubles below this.
EXACT = 2 ** 53
NOT_TERM = np.ones(256, bool)
NOT_TERM[128:] = False
for _first, _last in ((48, 57), (65, 90), (97, 122)):
    NOT_TERM[_first:_last + 1] = False


def _terms(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of the terms of each text, in order."""
    for block in X.blocks(texts, lower=True, blank=NOT_TERM):
        yield from block.docs()


def _postings(shared):
    """Texts -> number of terms, the items' terms in them and their occurrences."""
    def run(batches):
        vocabulary = shared.value
        for batch in X.small(batches):
            n, at, terms, tf = [], [0], [], []
            for _, h in _terms(X.text_bytes(batch.column("text"))):
                n.append(len(h))
                i = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                t, c = np.unique(i[vocabulary[i] == h], return_counts=True)
                terms.append(t.astype(np.int32))
                tf.append(c.astype(np.int32))
                at.append(at[-1] + len(t))
            at = pa.array(at, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x) if x else np.empty(0, np.int32)))
                     for x in (terms, tf)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), *lists],
                                             names=["doc_id", "n", "terms", "tf"])
    return run


def split_order(ptr: np.ndarray, term: np.ndarray, weight: np.ndarray, leaf: int):
    """Tree over sparse rows: their order, and its nodes as (first row, end row,
    children) in that order, parents before children. A node is halved by
    holding or not the term of largest weighted variance among those that at least
    an eighth of its rows hold or miss; without one, in the middle."""
    order = np.arange(len(ptr) - 1)
    nodes: list[list] = []
    todo = [(0, len(order), None)]
    while todo:
        a, b, parent = todo.pop()
        me = len(nodes)
        nodes.append([a, b, []])
        if parent is not None:
            nodes[parent][2].append(me)
        if b - a <= leaf:
            continue
        rows = order[a:b]
        size = ptr[rows + 1] - ptr[rows]
        end = np.cumsum(size)
        own = np.repeat(np.arange(b - a), size)
        t = term[np.repeat(ptr[rows] - (end - size), size) + np.arange(end[-1])]
        held = np.bincount(t, minlength=len(weight))
        gain = weight ** 2 * held * (b - a - held)
        gain[(held * 8 < b - a) | ((b - a - held) * 8 < b - a)] = 0
        best = int(gain.argmax())
        has = np.zeros(b - a, bool)
        has[own[t == best]] = True
        mid = a + int(has.sum())
        if gain[best] > 0:
            order[a:b] = np.r_[rows[has], rows[~has]]
        else:
            mid = (a + b) // 2
        todo += [(a, mid, me), (mid, b, me)]
    return order, nodes


def _gather(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the entries of some rows one after the other, and where each
    row's begin."""
    size = ptr[rows + 1] - ptr[rows]
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    return np.repeat(ptr[rows] - (end - size), size) + np.arange(total), end - size


def _maxima(row: np.ndarray, term: np.ndarray, value: np.ndarray, n_terms: int):
    """Largest value of each (row, term): ptr over 0..max row, terms, values."""
    key = row * n_terms + term
    by = np.argsort(key, kind="stable")
    key, value = key[by], value[by]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    top = np.maximum.reduceat(value, first) if len(key) else value
    return key[first] // n_terms, (key[first] % n_terms).astype(np.int64), top


class ItemTree:
    """The items of a block: coordinates by item, nodes with their maxima."""

    def __init__(self, number: np.ndarray, item_id: np.ndarray, ptr, term, q, weight: np.ndarray, k: int):
        self.k, self.weight, self.n_terms = k, weight, len(weight)
        order, nodes = split_order(ptr, term, weight, ITEM_LEAF)
        at, begin = _gather(ptr, order)
        self.number, self.item_id = number[order], item_id[order]
        term, q = term[at], q[at]
        row = np.repeat(np.arange(len(order)), ptr[order + 1] - ptr[order])
        self.first = np.array([a for a, _, _ in nodes])
        self.end = np.array([b for _, b, _ in nodes])
        self.children = [np.array(c, np.int64) for _, _, c in nodes]
        rows, terms, tops, ptrs, self.leaf = [], [], [], [0], {}
        for v, (a, b, c) in enumerate(nodes):
            own = slice(*np.searchsorted(row, [a, b]))
            _, t, top = _maxima(np.zeros(own.stop - own.start, np.int64), term[own], q[own], self.n_terms)
            terms.append(t)
            tops.append(top)
            ptrs.append(ptrs[-1] + len(t))
            if not c:  # a leaf holds its items' coordinates over its terms
                dense = np.zeros((b - a, len(t)), q.dtype)
                dense[row[own] - a, np.searchsorted(t, term[own])] = q[own]
                self.leaf[v] = (t, dense)
        self.ptr = np.array(ptrs)
        self.term, self.top = np.concatenate(terms), np.concatenate(tops)

    def bounds(self, nodes: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Bound of each item node against document coordinates ``most``."""
        at, begin = _gather(self.ptr, nodes)
        out = np.add.reduceat(np.r_[self.top[at] * most[self.term[at]], 0], begin)
        out[self.ptr[nodes + 1] == self.ptr[nodes]] = 0
        return out


class Best:
    """The best ``k`` documents of every item so far, and the score to reach."""

    def __init__(self, tree: ItemTree, floor: np.ndarray):
        self.tree, self.need = tree, np.maximum(floor, 1)
        self.score = [np.empty(0)] * len(floor)
        self.doc = [np.empty(0, np.int64)] * len(floor)
        self._nodes()

    def _nodes(self) -> None:
        t = self.tree
        cut = np.stack([t.first, t.end], 1).ravel()
        self.node_need = np.minimum.reduceat(np.r_[self.need, np.inf], cut)[::2]

    def offer(self, first: int, scores: np.ndarray, docs: np.ndarray) -> None:
        """Scores (item, document) of the items from ``first`` on."""
        for i in np.flatnonzero((scores >= self.need[first:first + len(scores), None]).any(1)):
            item = first + i
            new = scores[i] >= self.need[item]
            s, d = np.r_[self.score[item].astype(scores.dtype), scores[i, new]], np.r_[self.doc[item], docs[new]]
            by = np.lexsort((d, -s))[:self.tree.k]
            self.score[item], self.doc[item] = s[by], d[by]
            if len(by) == self.tree.k:
                self.need[item] = max(self.need[item], s[by[-1]])

    def rows(self) -> pa.RecordBatch:
        size = [len(d) for d in self.doc]
        t = self.tree
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(t.number, size)), pa.array(np.repeat(t.item_id, size)),
             pa.array(np.concatenate(self.doc)), pa.array(np.concatenate(self.score).astype(np.int64))],
            names=["number", "item_id", "doc_id", "score"])


def search_chunk(tree: ItemTree, best: Best, doc: np.ndarray, ptr, term, x) -> int:
    """Search a chunk of documents (sparse rows of coordinates); returns the
    number of (item, document) pairs scored."""
    order, nodes = split_order(ptr, term, tree.weight, DOC_LEAF)
    doc = doc[order]
    at, _ = _gather(ptr, order)
    size = ptr[order + 1] - ptr[order]
    term, x = term[at], x[at]
    ptr = np.r_[0, np.cumsum(size)]
    leaf_of_row = np.zeros(len(order), np.int64)
    leaves = [v for v, (_, _, c) in enumerate(nodes) if not c]
    for n, v in enumerate(sorted(leaves, key=lambda v: nodes[v][0])):
        leaf_of_row[nodes[v][0]:nodes[v][1]] = n
    in_leaf, leaf_term, leaf_top = _maxima(np.repeat(leaf_of_row, size), term, x, tree.n_terms)
    place = np.full(tree.n_terms, -1)
    scored = 0

    def most(v: int) -> np.ndarray:
        a, b, _ = nodes[v]
        s = slice(*np.searchsorted(in_leaf, [leaf_of_row[a], leaf_of_row[b - 1] + 1]))
        out = np.zeros(tree.n_terms)
        np.maximum.at(out, leaf_term[s], leaf_top[s])
        return out

    def pruned(items: np.ndarray, bound: np.ndarray) -> np.ndarray:
        return items[bound >= best.node_need[items]]

    stack = [(0, np.zeros(1, np.int64), None)]
    while stack:
        v, items, bound = stack.pop()
        if bound is not None:
            items = pruned(items, bound)  # scores may have risen since
        if not len(items):
            continue
        a, b, below = nodes[v]
        if below:
            items = np.concatenate([tree.children[i] if len(tree.children[i]) else np.array([i]) for i in items])
            near = []
            for c in below:
                bound = tree.bounds(items, most(c))
                ok = bound >= best.node_need[items]
                near.append((float((bound - best.node_need[items])[ok].sum()), c, items[ok], bound[ok]))
            # the more promising child is popped first
            stack += [(c, i, bd) for _, c, i, bd in sorted(near, key=lambda z: z[0])]
            continue
        top = most(v)
        items = pruned(items, tree.bounds(items, top))
        while len(items) and any(len(tree.children[i]) for i in items):
            items = np.concatenate([tree.children[i] if len(tree.children[i]) else np.array([i]) for i in items])
            items = pruned(items, tree.bounds(items, top))
        if not len(items):
            continue
        own = slice(ptr[a], ptr[b])
        u = np.flatnonzero(top)
        place[u] = np.arange(len(u))
        dense = np.zeros((b - a, len(u)))
        dense[np.repeat(np.arange(b - a), size[a:b]), place[term[own]]] = x[own]
        for i in items:
            t, q = tree.leaf[i]
            some = place[t]
            ok = some >= 0
            scored += len(q) * (b - a)
            best.offer(int(tree.first[i]), q[:, ok] @ dense[:, some[ok]].T, doc[a:b])
        best._nodes()
        place[u] = -1
    return scored


def saturated(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Coordinate of a term that occurs ``tf`` times among a document's ``n``."""
    m = 100 - 25 + (25 * n * n_docs) // n_terms
    return ((1_000_000_000 * tf) // (1000 * tf + 12 * m)).astype(float)


def _chunks(batches):
    """Documents with postings as (ids, n, ptr, terms, tf) of bounded chunks."""
    held, size = [], 0
    for batch in X.small(batches, 256):
        at = batch.column("terms").offsets.to_numpy().astype(np.int64)
        s = slice(at[0], at[-1])
        held.append([batch.column("doc_id").to_numpy(), batch.column("n").to_numpy(), np.diff(at),
                     batch.column("terms").values.to_numpy()[s].copy(), batch.column("tf").values.to_numpy()[s].copy()])
        size += int(at[-1] - at[0])
        if size >= CHUNK_POSTINGS or 256 * len(held) >= CHUNK_DOCS:
            yield [np.concatenate(c) for c in zip(*held)]
            held, size = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _search(shared, n_docs: int, n_terms: int):
    def run(batches):
        tree, floor = shared.value
        best = Best(tree, floor)
        for doc, n, size, term, tf in _chunks(batches):
            some = size > 0
            doc, n, size = doc[some], n[some], size[some]
            if len(doc):
                x = saturated(tf.astype(np.int64), np.repeat(n, size), n_docs, n_terms)
                search_chunk(tree, best, doc, np.r_[0, np.cumsum(size)], term.astype(np.int64), x)
        yield best.rows()
    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Items with terms as (number, item_id, term hashes), block by block; the
    driver holds one block."""
    block, size = [], 0
    rows = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator()
    for number, row in enumerate(rows):
        h = next(_terms([row["text"].encode()]))[1]
        if not len(h):
            continue
        if block and (len(block) >= BLOCK_ITEMS or size + len(h) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append((number, row["item_id"], h))
        size += len(h)
    if block:
        yield block


def _best(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("number").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, block, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    sc = spark.sparkContext
    vocabulary = np.unique(np.concatenate([h for _, _, h in block]))
    shared = sc.broadcast(vocabulary)
    post = persist_cut(docs.mapInArrow(_postings(shared), "doc_id long, n long, terms array<int>, tf array<int>"),
                       spark, "dual-postings")
    n_docs, n_terms = post.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(vocabulary), np.int64)  # as many rows as the block has terms
    for t, c in post.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[t] = c
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(c) + 1))) for c in df], float)
    ptr, term, q, exact = [0], [], [], np.float64
    for _, _, h in block:
        t, c = np.unique(np.searchsorted(vocabulary, h), return_counts=True)
        if float((weight[t] * c).sum()) * 1e6 >= EXACT:
            exact = np.longdouble  # an item of some 300,000 terms: 64-bit mantissas, no BLAS
        term.append(t)
        q.append(weight[t] * c)
        ptr.append(ptr[-1] + len(t))
    number, ids = (np.array([b[i] for b in block], np.int64) for i in (0, 1))
    tree = ItemTree(number, ids, np.array(ptr), np.concatenate(term),
                    np.concatenate(q).astype(exact), weight, k)
    schema = "number long, item_id long, doc_id long, score long"
    none = sc.broadcast((tree, np.zeros(len(block), exact)))
    part = post.where(F.pmod(F.xxhash64("doc_id"), F.lit(FLOOR_PART)) == 0)
    floor = dict(_best(part.mapInArrow(_search(none, n_docs, n_terms), schema), k).where(F.col("rank") == k)
                 .select("number", "score").collect())  # one row for each item of the block
    floors = sc.broadcast((tree, np.array([floor.get(i, 0) for i in tree.number.tolist()], np.int64).astype(exact)))
    found = post.mapInArrow(_search(floors, n_docs, n_terms), schema)
    return persist_cut(_best(found, k).select("item_id", "rank", "doc_id", "score"), spark, "dual-found")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best documents (doc_id long, text) of every item (item_id long,
    text); other columns are ignored.

    Terms are maximal runs of ASCII letters and digits and of all other characters
    beyond ASCII, A-Z lower-cased. A term's weight and a document's coordinate are
    those of :func:`saturated` and ``floor(1000 ln((2N + 2) / (2 df + 1)))``; a
    score sums weight times coordinate over the item's terms, repeats included.

    Returns item_id, rank (int, from 1), doc_id, score (long); scores above 0,
    ties by ascending doc_id. Null texts and texts without terms have no terms;
    rows with a null id are left out. Each row is a document, or an item, of its
    own: a repeated document row is listed again, a repeated item row ranked again.
    Terms are compared by 64 bits of hash. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    out = None
    for block in _blocks(items):
        found = _search_block(docs, block, k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame(
        [], "item_id long, rank int, doc_id long, score long")
