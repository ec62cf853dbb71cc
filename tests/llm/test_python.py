"""Containment, byte-level BPE and the fitted models."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.llm import bpe, contain, langid, line_crf, toxicity
from tests.llm import brute

DOCS = "doc_id long, text string"


# ---- containment ------------------------------------------------------------------

def _contaminated(seed):
    rng = random.Random(seed)
    items = [" ".join(f"i{k}w{j}" for j in range(rng.choice([5, 9, 12, 30, 60, 200]))) for k in range(25)]
    items += [None, "", "too short here", items[0]]
    docs = []
    for d in range(80):
        w = [f"d{rng.randrange(10**6)}" for _ in range(rng.choice([0, 20, 300, 3000]))]
        if rng.random() < 0.6:
            part = (items[rng.randrange(25)]).upper().split()
            cut = rng.choice([0, 0, 0, len(part) // 20, len(part) // 3])
            at = rng.randrange(len(w) + 1)
            w[at:at] = part[cut:]
        docs.append((d, rng.choice([" ", "\n", "  \t"]).join(w)))
    return docs + [(90, None), (91, "")], list(enumerate(items))


@pytest.mark.parametrize("most", [contain.MOST_ITEM_BYTES, 0])
def test_containment_equals_brute_force(spark, most):
    docs, items = _contaminated(5)
    out = contain.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"),
                               80, most)
    assert {tuple(r) for r in out.collect()} == brute.contained(docs, items, 80)


def test_decontaminate_keeps_columns_and_clean_rows(spark):
    item = "a b c d e f g h"
    d = spark.createDataFrame([(1, f"x {item} y", "p"), (2, "x y", "q"), (None, item, "r"), (3, None, "s"), (2, "x y", "q")],
                              DOCS + ", item_id string")
    items = spark.createDataFrame([(7, item, 1), (None, "x y z u v", 1)], "item_id long, text string, doc_id int")
    out = contain.decontaminate(d, items)
    assert out.columns == d.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "2", "3", "None"]
    assert contain.contaminated(d, items.limit(0)).collect() == []
    assert contain.contaminated(d.limit(0), items).collect() == []


# ---- byte-level BPE ---------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def exact():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact(vocabulary):
    h = vocabulary.hash
    assert sorted(h.value) == list(range(len(vocabulary.tokens)))
    assert all(h.get(t) == i for i, t in enumerate(vocabulary.tokens))
    assert h.get(b"no such token at all") == -1
    assert bpe.PerfectHash([b"x"]).get(b"x") == 0 and bpe.PerfectHash([]).get(b"x") == -1


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.sets(st.binary(max_size=6), max_size=40), st.integers(0, 2000)))
def test_perfect_hash_of_any_size(keys):
    keys = [b"%d" % i for i in range(keys)] if isinstance(keys, int) else sorted(keys)
    h = bpe.PerfectHash(keys)
    assert [h.get(k) for k in keys] == list(range(len(keys)))
    assert h.get(b"not one of them") == -1 and len(h.value) == max(1, len(keys))


def test_perfect_hash_refuses_repeated_keys():
    with pytest.raises(ValueError):
        bpe.PerfectHash([b"a", b"a"])


def test_vocabulary_of_bytes_alone(exact):
    e = bpe.Encoder(bpe.Vocabulary([bytes([b]) for b in range(256)], public_tokenizers.PATTERN))
    assert list(e.encode("héy")) == list("héy".encode())


def test_very_long_text(vocabulary, exact):
    text = "thshble onininger, " * 20_000 + "x" * 20_000
    assert list(bpe.Encoder(vocabulary).encode(text)) == exact.encode_ordinary(text)


def test_decode_replaces_a_column_of_its_name(spark, vocabulary):
    d = spark.createDataFrame([(1, "a b", "own")], DOCS + ", bytes string")
    ids = bpe.encode(d, vocabulary).join(d.select("doc_id", "bytes"), "doc_id")
    assert [tuple(r) for r in bpe.decode(ids, vocabulary).collect()] == [(1, bytearray(b"a b"))]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_encoding_equals_the_library(vocabulary, exact, text):
    ids = bpe.Encoder(vocabulary).encode(text)
    assert list(ids) == exact.encode_ordinary(text)
    assert bpe.Decoder(vocabulary).decode(np.array(ids, np.int32)).decode() == text


def test_bpe_query(spark, vocabulary, exact):
    texts = [None, "", " ", "héllo wörld 123's <|endoftext|>", "a" * 5000, "日本語 \r\n\t x", "b " * 3000]
    d = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], DOCS + ", ids string")
    for r in bpe.digests(d, vocabulary).collect():
        ids = exact.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == brute.sha(",".join(map(str, ids)).encode())
        assert r.decoded_sha256 == brute.sha((texts[r.doc_id] or "").encode())
    assert bpe.digests(d.limit(0), vocabulary).collect() == []


def test_small_memories_change_nothing(vocabulary, exact, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    e = bpe.Encoder(vocabulary)
    for t in ["some words of a text", "of other wordings", "some words again", "thshble onininger"] * 3:
        assert list(e.encode(t)) == exact.encode_ordinary(t)
    monkeypatch.setattr(bpe, "REMEMBERED_CHARS", 10)
    for t in ["some words of a text", "of other wordings"] * 2:
        assert list(e.encode(t)) == exact.encode_ordinary(t)


def _made_up(seed, n, letters="thenonrigs", sizes=range(4, 14)):
    rng = random.Random(seed)
    return ["".join(rng.choices(letters, k=rng.choice(sizes))) for _ in range(n)]


def test_short_pretokens_are_merged_together(vocabulary, exact, monkeypatch):
    alone = []
    heap = bpe.Encoder.merge
    monkeypatch.setattr(bpe.Encoder, "merge", lambda self, w: alone.append(w) or heap(self, w))
    texts = ["", *(" ".join(_made_up(k, 300)) for k in range(20)), "x" * 500, "", "thshble onininger"]
    got = bpe.Encoder(vocabulary).encode_all(texts)
    assert got == [exact.encode_ordinary(t) for t in texts]
    assert len(alone) < 100  # of some 6,000


@pytest.mark.parametrize("own", [False, True])
def test_columns_equal_the_heap(vocabulary, monkeypatch, own):
    monkeypatch.setattr(bpe, "COLUMNS", 7)
    rng = random.Random(3)
    if own:  # ranks in no order: a merge may bring a pair of lower rank beside it
        longer = sorted({w.encode() for w in _made_up(1, 3000, "abc", range(2, 9))})
        rng.shuffle(longer)
        vocabulary = bpe.Vocabulary(longer + [bytes([b]) for b in range(256)], public_tokenizers.PATTERN)
    e = bpe.Encoder(vocabulary)
    words = [w.encode() for w in _made_up(2, 2000, "abc", range(2, 40)) + _made_up(3, 2000) + ["é語" * 5, "a" * 32] * 20]
    words += [rng.randbytes(k) for k in range(2, 40) for _ in range(20)]
    assert e.merge_all(words) == [e.merge(w) for w in words]
    assert e.merge_columns(words[:1]) == [e.merge(words[0])] and e.merge_all([]) == []


def test_columns_where_nothing_merges():
    e = bpe.Encoder(bpe.Vocabulary([bytes([b]) for b in range(256)], public_tokenizers.PATTERN))
    words = [b"ab", b"\x00\xff"] * 10 + [b"abc"] * 20
    assert e.merge_all(words) == [tuple(w) for w in words]


# ---- line field ---------------------------------------------------------------------

def _enumerate(score, stay):
    """Marginals by summing over all labelings."""
    n = len(score)
    total, good = 0.0, np.zeros(n)
    for mask in range(2 ** n):
        y = [(mask >> k) & 1 for k in range(n)]
        s = sum(score[k] for k in range(n) if y[k])
        s += sum(stay[0] if y[k] and y[k + 1] else stay[1] if not y[k] and not y[k + 1] else 0 for k in range(n - 1))
        total += np.exp(s)
        good += np.exp(s) * np.array(y)
    return good / total


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    sizes = [1, 5, 3, 1, 7]
    score, stay = rng.normal(size=sum(sizes)), np.array([0.7, -0.4])
    at = np.cumsum([0] + sizes)
    p = line_crf.marginals(score, at, stay)
    for a, b in zip(at[:-1], at[1:]):
        assert np.allclose(p[a:b], _enumerate(score[a:b], stay))


def test_fit_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    x, at, y = rng.normal(size=(9, 2)), np.array([0, 4, 9]), rng.integers(0, 2, 9).astype(float)
    w, stay = line_crf.fit(x, at, y, steps=400)
    theta = np.r_[w, stay]

    def loss(t):
        out = 5e-5 * 9 * (t @ t)
        for a, b in zip(at[:-1], at[1:]):
            s, st_ = x[a:b] @ t[:2], t[2:]
            z = 0.0
            for mask in range(2 ** (b - a)):
                z += np.exp(_energy(s, [(mask >> k) & 1 for k in range(b - a)], st_))
            out += np.log(z) - _energy(s, y[a:b], st_)
        return out

    best = loss(theta)
    for k in range(4):
        for d in (-0.05, 0.05):
            t = theta.copy()
            t[k] += d
            assert loss(t) >= best - 1e-6


def _energy(s, y, stay):
    out = sum(a for a, b in zip(s, y) if b)
    return out + sum(stay[0] if a and b else stay[1] if not a and not b else 0 for a, b in zip(y[:-1], y[1:]))


def _quality_docs(spark, seed=0, n=240):
    rng = random.Random(seed)

    def line(bad):
        w = [rng.choice(["alpha", "beta", "gamma", "delta", "of", "the"]) for _ in range(rng.randrange(4, 14))]
        return " | ".join(x + "###" for x in w).upper() if bad else " ".join(w).capitalize() + "."

    rows = [(i, "\n".join(line(i % 4 == 0 and k > 0) for k in range(rng.randrange(2, 9))), int(i % 4 != 0)) for i in range(n)]
    return spark.createDataFrame(rows, DOCS + ", quality int")


def test_quality_field(spark):
    d = _quality_docs(spark)
    theta = line_crf.fit_quality(d.select("doc_id", "text"), d.select("doc_id", "quality"), F.col("doc_id") % 2 == 0)
    out = line_crf.score_quality(d, theta).join(d, "doc_id").where("doc_id % 2 = 1 OR doc_id % 4 = 0").collect()
    assert all((r.score >= 0.3) == (r.quality == 1) for r in out)
    # length-weighted: one bad line among many good ones does not sink a document
    mixed = spark.createDataFrame([(1, "\n".join(["Alpha beta gamma of the delta."] * 9 + ["A### | B###"])), (2, None),
                                   (3, ""), (4, "\n\n")], DOCS)
    got = {r.doc_id: r.score for r in line_crf.score_quality(mixed, theta).collect()}
    assert got[1] > 0.5 and got[2] == got[3] and all(0 <= s <= 1 for s in got.values())
    kept = line_crf.keep_good(d, theta, 0.3)
    assert kept.columns == d.columns and kept.count() == 180
    again = line_crf.fit_quality(d.repartition(7), d.select("doc_id", "quality"), F.col("doc_id") % 2 == 0)
    assert np.allclose(theta, again)


def test_models_without_labels(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    theta = line_crf.fit_quality(d, none, F.lit(True))
    assert {r.score for r in line_crf.score_quality(d, theta).collect()} == {0.5}
    model = toxicity.fit_toxicity(d, none, F.lit(True))
    assert {r.score for r in toxicity.score_toxicity(d, model).collect()} == {0.5}
    assert line_crf.score_quality(d.limit(0), theta).collect() == toxicity.score_toxicity(d.limit(0), model).collect() == []


# ---- toxicity -----------------------------------------------------------------------

def test_swapped_terms():
    assert toxicity.swapped("The Women and a MUSLIM man.") == "the men and a christian girl."
    assert toxicity.swapped("No group here, womenfolk") is None
    for g in toxicity.IDENTITY_TERMS:  # a swap is a permutation of each list
        assert len({toxicity.swapped(t) for t in g}) == len(g)


def test_counterfactuals_remove_the_group_bias(spark):
    """'muslim' is frequent in toxic sentences only by the data's making."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        group = "muslim" if rng.random() < (0.9 if toxic else 0.1) else "christian"
        own = "idiot" if toxic and rng.random() < 0.7 else "filler"
        rows.append((i, f"word{rng.randrange(50)} the {group} neighbour is {own} word{rng.randrange(50)}.", int(toxic)))
    d = spark.createDataFrame(rows, DOCS + ", toxic int")
    neutral = spark.createDataFrame([(1, "a muslim neighbour"), (2, "a christian neighbour"), (3, "an idiot"),
                                     (4, None), (5, "")], DOCS)

    def scores(fairness):
        model = toxicity.fit_toxicity(d.select("doc_id", "text"), d.select("doc_id", "toxic"), F.lit(True),
                                      fairness=fairness)
        return {r.doc_id: r.score for r in toxicity.score_toxicity(neutral, model).collect()}

    plain, fair = scores(0.0), scores(50.0)
    assert plain[1] - plain[2] > 0.3
    assert abs(fair[1] - fair[2]) < 0.1 and fair[1] < plain[1]
    assert fair[3] > 0.7 and fair[4] == fair[5]


# ---- language -----------------------------------------------------------------------

def test_languages(spark):
    rng = random.Random(6)
    stems = {"xx": "ba be bi bo bu".split(), "yy": "zor zar zir zur".split()}
    rows = []
    for i in range(300):
        lang = ("xx", "yy")[i % 2]
        w = ["".join(rng.choice(stems[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(30)]
        rows.append((i, " ".join(w).upper() if i % 5 == 0 else ", ".join(w), lang if i % 7 else None))
    rows += [(400, None, "xx"), (401, "", "xx"), (402, "12 € ### 。", "xx"), (403, "zorzarzorzarzur", None),
             (404, "bobubabebibo " * 3, None), (404, "bobubabebibo " * 3, None)]
    d = spark.createDataFrame(rows, DOCS + ", lang string")
    out = langid.predict_held_out(d).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(by[i].lang_pred == ("xx", "yy")[i % 2] and 0.5 <= by[i].score <= 1 for i in range(300))
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (400, 401, 402))
    assert by[403].lang_pred == "yy" and by[403].n_known_words == 0  # unseen words back off to n-grams
    assert by[404].lang_pred == "xx"
    assert langid.predict_held_out(d.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.predict_held_out(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_rare_language_among_many_keeps_its_words(spark):
    """Forty languages of 400 frequent words each, one of few short texts."""
    rng = random.Random(8)
    rows = []
    for k in range(40):
        own = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(400)]
        rows += [(10 * k + i, " ".join(own * 3), f"l{k:02}") for i in range(2)]
    rare = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(6)]
    rows += [(1000 + i, " ".join(rare), "rare") for i in range(2)]
    d = spark.createDataFrame(rows, DOCS + ", lang string")
    out = langid.predict_language(d, langid.fit_language(d, F.lit(True))).collect()
    assert all(r.n_known_words == r.n_words for r in out)
    assert {r.doc_id: r.lang_pred for r in out} == {i: x for i, _, x in rows}
