"""Jaccard classes and substring deduplication against brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revlens.llm import partenum as P
from revlens.llm import textops as X
from revlens.llm.components import components
from revlens.llm.substring import remove_repeats
from tests.llm import brute

DOCS = "doc_id long, text string"


def _edited(rng, base, edits):
    w = base.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def _corpus(seed):
    """Copies, a chain of edited copies, a shared passage, odd texts."""
    rng = random.Random(seed)
    base = " ".join(f"w{rng.randrange(400)}" for _ in range(120))
    passage = " ".join(f"p{i}" for i in range(70))
    texts = [None, "", " \n\t", "one two", "One  two", "a b c d", "a b c d e", "q " * 300, "q " * 200]
    texts += [base] * 6 + [base.upper()]
    chain = base
    for _ in range(25):
        chain = _edited(rng, chain, rng.randrange(1, 6))
        texts.append(chain)
    for _ in range(12):
        own = " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 60)))
        texts.append(f"{own} {passage} {own[::-1]}")
    for _ in range(12):
        texts.append(" ".join(f"v{rng.randrange(30)}" for _ in range(rng.randrange(4, 30))))
    texts.append(base + " " + passage + " " + base)
    rng.shuffle(texts)
    return [(i * 3 - 20, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,words,percent", [(1, 4, 85), (2, 5, 80), (3, 1, 50)])
def test_classes_equal_brute_force(spark, seed, words, percent):
    rows = _corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           P.jaccard_classes(spark.createDataFrame(rows, DOCS), words, percent).collect()}
    assert got == brute.classes(rows, words, percent)


def test_classes_with_tiny_blocks(spark, monkeypatch):
    """Buckets larger than a block are searched block by block."""
    monkeypatch.setattr(P, "BLOCK_NODES", 3)
    rows = _corpus(7)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           P.jaccard_classes(spark.createDataFrame(rows, DOCS), 2, 70).collect()}
    assert got == brute.classes(rows, 2, 70)


def test_classes_of_odd_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert P.jaccard_classes(empty).collect() == []
    # repeated rows, a null id, and extra columns named like the operator's own
    d = spark.createDataFrame([(1, "a b c d", 9, "x"), (1, "a b c d", 9, "x"), (None, "a b c d", 1, "y"),
                               (2, "a b c d", 1, "z")], DOCS + ", node long, component_id string")
    assert sorted(tuple(r) for r in P.jaccard_classes(d).collect()) == [(1, 1, 1), (1, 1, 1), (2, 1, 1)]
    kept = P.keep_first(d, 4, 85)
    assert kept.columns == d.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.sampled_from([50, 80, 85, 100]))
def test_linked_sets_share_a_signature(seed, size, percent):
    rng = random.Random(seed)
    a = {rng.randrange(2**60) for _ in range(size)}
    b = set(a)
    while True:  # edit b as long as the pair stays linked
        c = set(b)
        c.discard(next(iter(c))) if rng.random() < 0.5 and len(c) > 1 else c.add(rng.randrange(2**60))
        if 100 * len(a & c) < percent * len(a | c):
            break
        b = c
        if rng.random() < 0.1:
            break
    bands = P.Bands(percent)
    sets = [P.np.sort(P.np.array(sorted(s), P._U)) for s in (a, b)]
    signed = [{x for k in (0, 1) for x in P.signatures(s, bands.of(len(s)) + k, bands).tolist()} for s in sets]
    assert signed[0] & signed[1]
    slots = bands.slots(max(bands.of(len(s)) for s in sets))
    assert P._far(*(P.odd_sketch(s, slots) for s in sets)) <= len(a ^ b) <= P._most(len(a), len(b), percent)


@pytest.mark.parametrize("size", [250, 700, 5000])
@pytest.mark.parametrize("percent", [80, 85])
def test_large_sets_at_the_threshold_share_a_signature(size, percent):
    """Pairs with as many differences as a link allows, enumerated like small ones."""
    rng = P.np.random.default_rng(size + percent)
    bands = P.Bands(percent)
    n1, n2, k2 = bands.parts(bands.of(size))
    assert n2 > 1 and k2 >= 1 and (k2 + 1) * n1 > bands.differences(bands.of(size))
    for share in (0.0, 0.3, 0.5, 1.0):  # of the differences that are insertions
        for _ in range(6):
            a = rng.integers(0, 2**63, size, dtype=P._U)
            most = (100 - percent) * size // 100
            gone, new = int(most * (1 - share)), int(most * share)
            b = P.np.r_[a[gone:], rng.integers(2**63, 2**64 - 1, new, dtype=P._U)]
            if 100 * (size - gone) < percent * (size + new):
                continue
            signed = [{x for k in (0, 1) for x in P.signatures(P.np.sort(s), bands.of(len(s)) + k, bands).tolist()}
                      for s in (a, b)]
            assert signed[0] & signed[1]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components_equal_union_find(spark, pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}


@pytest.mark.parametrize("seed,width", [(1, 50), (2, 12)])
def test_repeats_equal_brute_force(spark, seed, width):
    rows = _corpus(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in
           remove_repeats(spark.createDataFrame(rows, DOCS), width, seed=5).collect()}
    assert got == brute.kept_words(rows, width)


@pytest.mark.parametrize("cut", [(0, 40), (25, 65), (50, 90), (0, 90)])
def test_block_repeated_inside_a_document(spark, cut):
    """Each place of a block loses what a smaller document holds of it."""
    block = [f"b{i}" for i in range(90)]
    own = [" ".join(f"{c}{i}" for i in range(40)) for c in "stuvxyz"]
    whole, part = " ".join(block), " ".join(block[slice(*cut)])
    rows = [(1, f"{own[0]} {part} {own[1]}"), (2, f"{own[2]} {whole} {own[3]} {whole} {own[4]} {whole}"),
            (3, f"{whole} {whole} {own[5]}"), (4, f"{own[6]} {part} {part}"), (5, "q " * 30), (6, "q " * 60 + part)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in
           remove_repeats(spark.createDataFrame(rows, DOCS), 12, seed=5).collect()}
    assert got == brute.kept_words(rows, 12)


def test_repeats_of_odd_tables(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS), 3, 2).collect() == []
    d = spark.createDataFrame([(1, "a b c", 1), (1, "a b c", 1), (None, "a b c", 1), (2, "z a b c", 2)],
                              DOCS + ", kept long")
    got = sorted((str(r.doc_id), r.n_removed, r.kept) for r in remove_repeats(d, 3, 2).collect())
    assert got == [("1", 0, "a b c"), ("1", 0, "a b c"), ("2", 3, "z"), ("None", 0, "a b c")]


def test_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK_BYTES", 1 << 12)
    long = " ".join(f"w{i % 5003}" for i in range(40_000))
    rows = [(1, long), (2, "x " + long)]
    got = {r.doc_id: r.n_removed for r in remove_repeats(spark.createDataFrame(rows, DOCS), 50).collect()}
    assert got == {1: 0, 2: 40_000}
    assert {r.component_id for r in P.jaccard_classes(spark.createDataFrame(rows, DOCS)).collect()} == {1}
