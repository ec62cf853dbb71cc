"""HyperMinHash classes against brute force; registers, densification, estimate."""

import random

import numpy as np
import pytest

from revlens.llm import hyperminhash as H
from revlens.llm import textops as X
from tests.llm import brute
from tests.llm.test_near import _corpus, _edited

DOCS = "doc_id long, text string"


def _classes(spark, rows, words, percent, schema=DOCS):
    got = H.near_duplicates(spark.createDataFrame(rows, schema), words, percent).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


@pytest.mark.parametrize("seed,words,percent", [(11, 3, 85), (12, 5, 80), (13, 1, 50)])
def test_classes_equal_brute_force(spark, seed, words, percent):
    rows = _corpus(seed)
    assert _classes(spark, rows, words, percent) == brute.classes(rows, words, percent)


def test_blocks_and_a_large_group(spark, monkeypatch):
    """One group of near copies, many of them not linked to its smallest, and
    blocks smaller than its buckets."""
    monkeypatch.setattr(H, "BLOCK_NODES", 4)
    rng = random.Random(5)
    base = " ".join(f"w{rng.randrange(300)}" for _ in range(150))
    rows = [(i, _edited(rng, base, rng.randrange(0, 9))) for i in range(60)] + [(60 + i, base) for i in range(20)]
    want = brute.classes(rows, 3, 85)
    assert len({c for _, c in want.values()}) > 3
    assert _classes(spark, rows, 3, 85) == want


def test_odd_tables(spark):
    """Nulls, empty and very long texts, repeated rows, further columns, no rows."""
    long = " ".join(f"v{i % 7919}" for i in range(120_000))
    rows = [(5, long, 1), (3, long + " end", 2), (None, long, 3), (7, None, 4), (8, "", 5), (9, " \n", 6),
            (4, "a b", 7), (4, "a b", 7), (2, "A  B", 8)]
    d = spark.createDataFrame(rows, "doc_id long, text string, node long").selectExpr(
        "*", "1 AS n_shingles", "'x' AS key", "2 AS component_id")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in H.near_duplicates(d).collect())
    assert got == [(2, 2, True), (3, 3, True), (4, 2, False), (4, 2, False), (5, 3, False),
                   (7, 7, True), (8, 8, True), (9, 9, True)]
    assert H.near_duplicates(d.limit(0)).collect() == []


def test_rows_of_one_id_are_judged_by_their_text(spark):
    rows = [(1, "a b c d e"), (2, "f g h i j"), (2, "a b c d e"), (3, "f g h i j")]
    got = sorted(map(tuple, H.near_duplicates(spark.createDataFrame(rows, DOCS)).select("doc_id", "component_id")
                     .collect()))
    assert got == [(1, 1), (2, 1), (2, 2), (3, 2)]


def _set(rng, n):
    return rng.integers(0, 2**64, n, dtype=np.uint64)


def test_registers_hold_zeros_and_mantissa():
    rng = np.random.default_rng(3)
    s = _set(rng, 2000)
    r = H.registers(s)
    x = X.mix(s ^ X.GRAM[40])
    for j in range(H.BUCKETS):
        own = [int(v) for v in x if int(v) >> 56 == j]
        if not own:
            assert r[j] == 0
            continue
        bits = f"{min(own):064b}"[8:56]
        zeros = len(bits) - len(bits.lstrip("0"))
        tail = (bits[zeros + 1:] + "0" * 10)[:10]
        assert r[j] == (zeros + 1 << 10) + int(tail, 2)


def test_densified_registers_agree_like_the_sets():
    """Small sets, where most buckets are empty: agreement near the similarity."""
    rng = np.random.default_rng(4)
    share = []
    for _ in range(300):
        s = _set(rng, 21)
        a, b = (H.densified(H.registers(x)) for x in (s[:20], s[1:]))
        assert (a > 0).all() and (b > 0).all()
        share.append((a == b).mean())
    assert abs(np.mean(share) - 19 / 21) < 0.02
    full = H.registers(_set(rng, 50_000))
    assert (H.densified(full) == full).all()


@pytest.mark.parametrize("percent", [50, 80, 85, 95, 100])
def test_bands_miss_rarely(percent):
    rows = H.band_rows(percent)
    assert (1 - (percent / 100) ** rows) ** (H.BUCKETS // rows) <= H.MISS


def test_estimate_is_corrected_for_chance(monkeypatch):
    """With few mantissa bits chance makes many registers equal; the estimate of
    disjoint and of overlapping sets stays right."""
    monkeypatch.setattr(H, "MANTISSA", 1)
    rng = np.random.default_rng(6)
    for n, m, both in ((3000, 3000, 0), (3000, 1000, 0), (2000, 2000, 1000)):
        raw, est = [], []
        for _ in range(60):
            s = _set(rng, n + m - both)
            a, b = H.registers(s[:n]), H.registers(s[n - both:])
            used, same = ((a | b) > 0).sum(), ((a == b) & (a > 0)).sum()
            raw.append(same / used)
            est.append(float(H.estimate(np.array([same]), np.array([used]), np.array([n]), np.array([m]))[0]))
        truth = both / (n + m - both)
        assert abs(np.mean(est) - truth) < 0.03 and np.mean(raw) - truth > 0.05


def _likely(a, b, percent):
    x, y = H.registers(a), H.registers(b)[None]
    return H.likely((x, H.occupied(x)), (y, H.occupied(y)), len(a), np.array([len(b)]), percent)


def test_no_link_is_filtered():
    """Pairs just at the threshold, of all sizes; and the filter bites."""
    rng = np.random.default_rng(7)
    for n in (7, 40, 150, 300, 1000, 4000):
        k = int(n * 0.15 / 1.85)
        for _ in range(150):
            s = _set(rng, n + k)
            a, b = np.sort(s[:n]), np.sort(s[k:])
            if k == 0:
                b = a[:-1]
            assert H.linked(a, b, 85) and len(_likely(a, b, 85)[0]) == 1
    far = [len(_likely(s[:150], s[50:], 85)[0]) for s in (_set(rng, 200) for _ in range(200))]
    assert sum(far) < 10  # similarity 0.5


def test_linked_counts_exactly():
    a = np.arange(0, 17, dtype=np.uint64)
    assert H.linked(a, np.arange(0, 20, dtype=np.uint64), 85) and H.linked(a, a, 100)
    assert not H.linked(a, np.arange(0, 21, dtype=np.uint64), 85)
    assert not H.linked(a, a + np.uint64(100), 1)
