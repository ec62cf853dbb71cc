"""Merged text of a business: chunks joined in order are the whole text."""

import hashlib
import random

import pytest

from revlens.operators.merged import merged_text

ROWS = "BusinessID string, Review string"


def _whole(rows, sep):
    out = {}
    for b in {b for b, t in rows if b is not None and t is not None}:
        own = sorted({t for x, t in rows if x == b and t is not None},
                     key=lambda t: (hashlib.md5(t.encode()).hexdigest()[:8], t))
        out[b] = sep.join(own)
    return out


@pytest.mark.parametrize("chunk,sep", [(37, " "), (1000, ""), (5, "||"), (1 << 20, " ")])
def test_chunks_make_the_whole_text(spark, chunk, sep):
    rng = random.Random(chunk)
    rows = [("hot" if rng.random() < 0.4 else f"b{rng.randrange(20)}",
             "".join(rng.choice("abé \n") for _ in range(rng.randrange(60)))) for _ in range(400)]
    rows += [("empty", ""), ("b1", None), (None, "x"), ("b2", "y" * 500), ("hot", "z"), ("hot", "z")]
    got = {}
    for r in merged_text(spark.createDataFrame(rows, ROWS), chunk, sep).collect():
        assert len(r.text) <= chunk and r.chunk not in got.setdefault(r.BusinessID, {})
        got[r.BusinessID][r.chunk] = r.text
    assert all(sorted(c) == list(range(len(c))) for c in got.values())
    assert {b: "".join(c[i] for i in sorted(c)) for b, c in got.items()} == _whole(rows, sep)
    if chunk == 37:
        assert len(got["hot"]) > 50


def test_no_reviews(spark):
    assert merged_text(spark.createDataFrame([], ROWS)).collect() == []
