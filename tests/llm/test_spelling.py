"""Spelling variants against brute force: trees, pairs, forms, roots, words."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from revlens.llm import spelling as S

VOCAB = "word string, n long"


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(vocabulary, times=10):
    n = dict(vocabulary)
    out, form = {}, {}
    for w in n:
        near = sorted(((-n[x], x) for x in n if _near(w, x)))
        form[w] = near[0][1] if near and -near[0][0] >= times * n[w] else None
        out[w] = len(near)
    rows = []
    for w in n:
        r = w
        while form[r]:
            r = form[r]
        rows.append((w, n[w], out[w], form[w], n[form[w]] if form[w] else None, r))
    return sorted(rows)


def _vocabulary(seed, size=500):
    rng = random.Random(seed)
    words = {}
    while len(words) < size:
        w = "".join(rng.choice("aeérstÀ") for _ in range(rng.randrange(4, 10)))
        words.setdefault(w, rng.choice([2, 3, 30, 400, 5000]))
        if rng.random() < 0.7:
            i = rng.randrange(len(w))
            words.setdefault(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("xyé") + w[i:], w[:i] + "z" + w[i + 1:]]),
                             rng.choice([2, 5, 50]))
    return sorted(words.items())


def _rows(spark, vocabulary, **how):
    out = S.variants(spark.createDataFrame(vocabulary, VOCAB), **how)
    return sorted(map(tuple, out.select("word", "n", "n_near", "form", "form_n", "root").collect()))


def test_equals_brute_force(spark):
    v = _vocabulary(1)
    assert _rows(spark, v) == plain(v)


def test_many_cells_and_crowded_cells(spark, monkeypatch):
    """Top trees of many planes, cells split further, leaves of few words."""
    for name, x in (("CELL", 12), ("LEAF", 3), ("COMPARED", 2000)):
        monkeypatch.setattr(S, name, x)
    v = _vocabulary(2, 700)
    assert len(S.TopTree(S.letter_counts(S._codes([w for w, _ in v if len(w) == 7])), 1.0).nodes) > 3
    assert _rows(spark, v, times=3) == plain(v, 3)


def test_chains_ties_and_odd_words(spark):
    v = [("aaaaaaa", 2), ("aaaaaab", 20), ("aaaaabb", 200), ("aaaabbb", 2000), ("zzzzzzz", 3), ("zzzzzzy", 30),
         ("zzzzzzx", 30), ("q" * 40_000, 2), ("q" * 40_001, 50), ("q" * 39_999 + "r", 2), ("÷×ÿÀ", 5), ("÷×ÿ", 50)]
    got = _rows(spark, v)
    assert got == plain(v)
    root = {r[0]: r[5] for r in got}
    assert root["aaaaaaa"] == "aaaabbb" and root["zzzzzzz"] == "zzzzzzx" and root["q" * 40_000] == "q" * 40_001
    assert _rows(spark, []) == []
    with pytest.raises(ValueError):
        S.variants(spark.createDataFrame(v, VOCAB), times=1)


def test_words(spark):
    """Counts of runs, letters lost by the hash, odd rows and names."""
    rng = random.Random(3)
    pool = ["Réponse", "answers", "straße", "Ünïcode", "longerword", "tinyword", "x" * 5000]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(30))) + ", answers-answers1 ×÷×÷×÷×") for i in range(200)]
    docs += [(7, None), (8, ""), (None, "answers nullidword nullidword"), (9, "12 …")]
    want = collections.Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += len(run) >= 7
    want = sorted((w, n) for w, n in want.items() if n >= 2)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS run", "2 AS h", "3 AS at", "4 AS word")
    assert sorted(map(tuple, S.words(d).collect())) == want
    assert S.words(d.limit(0)).collect() == []


def test_letter_counts_and_order():
    c = S._codes(["aabÿ", "éébb"])
    v = S.letter_counts(c)
    assert v.sum() == 8 and v[0, 0] == 2 and v[1, S.LETTERS.index(0xE9)] == 2
    a, b = S._codes(["abcd", "abcd"]), S._codes(["abxcd", "badcx"])
    assert S.one_inserted(a, b).tolist() == [True, False]
    assert S.one_replaced(a, S._codes(["abxd", "bacd"])).tolist() == [True, False]


def test_range_search_prunes_and_finds_all():
    rng = np.random.default_rng(2)
    v = rng.integers(0, 3, (3000, S.DIMS)).astype(np.int8) * (np.arange(S.DIMS) < 9).astype(np.int8)
    tree = S.KdTree(v)
    q = v[:200].copy()
    q[np.arange(200), rng.integers(0, 9, 200)] += 1
    for down in (0, 1):
        got = {(i, j) for a, b in tree.near(q, down) for i, j in zip(a.tolist(), b.tolist())}
        far = v[None].astype(int) - q[:, None]
        up, off = np.maximum(far, 0).sum(2), np.maximum(-far, 0).sum(2)
        assert got >= {(int(i), int(j)) for i, j in zip(*np.nonzero((up <= 1) & (off <= down) & (up + off == 1 + down)))}
    for low, high, (a, b, _) in zip(tree.low, tree.high, tree.nodes):
        own = tree.v[tree.order[a:b]]
        assert (own >= low).all() and (own <= high).all()
