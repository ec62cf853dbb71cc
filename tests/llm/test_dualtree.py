"""Ranked search by dual trees against a plain scorer."""

import collections
import math
import random
import re

import numpy as np
import pytest

from revlens.llm import dualtree as D

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def _terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    """Sorted (item, rank, doc, score) rows, every pair scored."""
    tf = [(i, collections.Counter(_terms(t))) for i, t in docs if i is not None]
    tf = [(i, c, sum(c.values())) for i, c in tf if c]
    n, total = len(tf), sum(s for _, _, s in tf)
    df = collections.Counter(t for _, c, _ in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in tf:
            m = 100 - 25 + (25 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in _terms(text) if t in c)
            if s > 0:
                scored.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])] if item is not None else []
    return sorted(out)


def _corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"W{i}é" if i % 5 == 0 else f"w{i}" for i in range(150)]

    def text(size):
        topic = rng.randrange(5) * 30
        return " ".join(words[topic + min(29, int(rng.expovariate(0.15)))] for _ in range(size)) + rng.choice([".", "!\n", ""])
    docs = [(i * 7 - 50, text(rng.randrange(1, 80))) for i in range(n)]
    docs += [(10**6 + i, docs[3][1]) for i in range(30)]  # ties
    items = [(i, text(rng.randrange(1, 40))) for i in range(25)] + [(90, docs[3][1])]
    rng.shuffle(docs)
    return docs, items


def _rows(spark, docs, items, k=20):
    found = D.ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k)
    return sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()))


@pytest.mark.parametrize("seed,k", [(1, 20), (2, 3)])
def test_equals_every_pair_scored(spark, seed, k):
    docs, items = _corpus(seed)
    assert _rows(spark, docs, items, k) == plain(docs, items, k)


def test_small_blocks_chunks_and_leaves(spark, monkeypatch):
    for name, v in (("BLOCK_ITEMS", 10), ("CHUNK_DOCS", 64), ("ITEM_LEAF", 1), ("DOC_LEAF", 2), ("FLOOR_PART", 2)):
        monkeypatch.setattr(D, name, v)
    docs, items = _corpus(3)
    assert _rows(spark, docs, items) == plain(docs, items, 20)


def test_odd_tables(spark):
    docs = [(1, None), (2, ""), (3, " .,\n"), (4, "Alpha beta"), (5, "alpha"), (5, "alpha"), (None, "alpha"),
            (6, "ß alpha1 " + "gamma " * 60_000), (7, "x" * 200_000)]
    items = [(1, "ALPHA"), (1, "ALPHA"), (2, None), (3, ""), (4, "nowhere"), (None, "alpha"), (5, "gamma ß beta"),
             (6, "x" * 200_000)]
    got = _rows(spark, docs, items)
    assert got == plain(docs, items, 20) and len(got) == 3 + 3 + 2 + 1
    wide = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS n", "'a' AS terms", "2 AS score", "3 AS item_id")
    named = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS number", "2 AS rank", "4 AS doc_id")
    assert sorted(map(tuple, D.ranked_search(wide, named).collect())) == got
    for d, i in ((wide.limit(0), named), (wide, named.limit(0)), (wide.where("doc_id < 4"), named)):
        found = D.ranked_search(d, i)
        assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_scores_beyond_exact_doubles(spark, monkeypatch):
    """An item so long that doubles would round is summed with more bits."""
    docs, items = _corpus(5, 40)
    items = [(1, " ".join(t for _, t in items))]
    want = plain(docs, items, 20)
    monkeypatch.setattr(D, "EXACT", 1)
    assert _rows(spark, docs, items) == want


def _tree(rng, n_items, n_terms, k):
    ptr, term, q = [0], [], []
    for i in range(n_items):
        t = np.unique(rng.integers(0, n_terms // 4, 12) + (i % 4) * (n_terms // 4))
        term.append(t)
        q.append(rng.integers(1, 5000, len(t)).astype(float))
        ptr.append(ptr[-1] + len(t))
    number = np.arange(n_items)
    return D.ItemTree(number, number, np.array(ptr), np.concatenate(term), np.concatenate(q), np.ones(n_terms), k)


def test_bounds_hold_and_prune():
    """A node's bound is no less than any score below it, and most pairs of texts
    on different topics are never scored."""
    rng = np.random.default_rng(1)
    tree = _tree(rng, 64, 200, 5)
    size = np.full(2000, 15)
    term = np.concatenate([np.sort(rng.choice(50, 15, replace=False)) + (i % 4) * 50 for i in range(2000)])
    x = rng.integers(1, 900_000, len(term)).astype(float)
    best = D.Best(tree, np.zeros(64))
    scored = D.search_chunk(tree, best, np.arange(2000), np.r_[0, np.cumsum(size)], term, x)
    assert 0 < scored < 64 * 2000 * 0.6
    again = D.Best(tree, best.need.copy())  # from floors as good as the result
    assert D.search_chunk(tree, again, np.arange(2000), np.r_[0, np.cumsum(size)], term, x) <= scored
    assert all((a == b).all() for a, b in zip(again.doc, best.doc))
    dense = np.zeros((2000, 200))
    dense[np.repeat(np.arange(2000), 15), term] = x
    items = np.zeros((64, 200))
    for t, q in ((tree.leaf[v], v) for v in tree.leaf):
        items[tree.first[q]:tree.end[q], t[0]] = t[1]
    scores = items @ dense.T
    for i in range(64):
        assert sorted(best.score[i], reverse=True) == sorted(scores[i], reverse=True)[:5]
    every = tree.bounds(np.arange(len(tree.first)), dense.max(0))
    for v, (a, b) in enumerate(zip(tree.first, tree.end)):
        assert every[v] >= scores[a:b].max()
