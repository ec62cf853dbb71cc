"""Word and shingle hashing against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from revlens.llm import textops as X

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.text(st.sampled_from("aAbÉß \t\n\x0b\x0c\r\x1c  .#"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_words_are_the_pattern_and_hash_alike(texts):
    raw = [t.encode() for t in texts]
    seen = {}
    for block in X.blocks(raw):
        for row, h in block.docs():
            words = WORD.findall(texts[row])
            assert len(words) == len(h)
            for w, x in zip(words, h.tolist()):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_block_size_changes_nothing(monkeypatch):
    texts = [("w%d " % (i % 7) * (i % 50)).encode() for i in range(200)]

    def hashes():
        return [h.tolist() for b in X.blocks(texts) for _, h in b.docs()]

    large = hashes()
    monkeypatch.setattr(X, "BLOCK_BYTES", 64)
    assert hashes() == large


def test_shingle_set_of_short_texts():
    def s(text, n=4):
        return [X.shingle_set(h, n) for b in X.blocks([text.encode()], lower=True) for _, h in b.docs()][0]

    assert len(s("")) == 0 and len(s(" \n ")) == 0
    assert len(s("a b c")) == 1 and s("A  B\tc").tolist() == s("a b c").tolist()
    assert s("a b c").tolist() != s("a b d").tolist()
    assert len(s("a a a a a a")) == 1 and len(s("a b c d e")) == 2


def test_small_slices_keep_rows():
    batch = pa.RecordBatch.from_pydict({"x": list(range(1300))})
    assert [v for b in X.small([batch], 512) for v in b.column("x").to_pylist()] == list(range(1300))
    assert np.all([b.num_rows <= 512 for b in X.small([batch], 512)])
