"""Sentiment rules: hand-computed cases, both lookups, odd rows, plan shape."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revlens.operators import sentiment as S

ROWS = "id string, text string"
G, B = S.LEXICON["good"], S.LEXICON["bad"]


def _score(spark, *texts, **how):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], ROWS)
    rows = {r.id: r for r in S.sentiment(df, "text", **how).collect()}
    return [rows[str(i)] for i in range(len(texts))]


def _compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


CASES = [  # text, summed valence
    ("good", G),
    ("the food was good", G),
    ("not good", -0.74 * G),
    ("not that good", -0.74 * G),
    ("not all that good", -0.74 * G),
    ("not at all that good", G),                                  # beyond three words
    ("didn't like it", -0.74 * 1.5), ("isnt good", -0.74 * G),
    ("not bad", -0.74 * B),
    ("not never good", 0.74 * 0.74 * G),                          # turned twice
    ("very good", G + 0.293), ("very bad", B - 0.293),
    ("very much good", G + 0.293 * 0.95), ("very much more good", (G + 0.293) + 0.293 * 0.9),
    ("slightly good", G - 0.293), ("slightly cold", -(0.5 - 0.293)),
    ("barely almost cold", 0.0),                                  # weakened, never turned
    ("not very good", -0.74 * (G + 0.293)),
    ("never so good", 1.5 * (G + 0.293)),
    ("never this good", 1.5 * G), ("never ever this good", 1.25 * G),
    ("least good", -0.74 * G), ("at least good", G), ("very least good", G + 0.293 * 0.95),
    ("good but bad", 0.5 * G + 1.5 * B), ("good but bad but fun", 0.5 * G + 1.5 * B + 1.5 * 2.3),
    ("but good", 1.5 * G),
    ("kind of good", G), ("kind people", 2.4), ("kind", 2.4),
    ("good very bad", G + B - 0.293),
    ("good!", G + 0.292), ("bad!!", B - 2 * 0.292), ("good!!!!!!!!", G + 4 * 0.292),
    ("good?", G), ("good??", G + 2 * 0.18), ("bad????", B - 0.96), ("food!!??", 0.0),
    ("GOOD food", G + 0.733), ("GOOD", G), ("BAD food", B - 0.733), ("good FOOD", G),
    ("VERY good", G + 0.293 + 0.733), ("NOT good", -0.74 * G),
    ("(good), \"bad\"", G + B), ("a I good", G),
]


def test_rules(spark):
    got = _score(spark, *[t for t, _ in CASES])
    assert [(t, r.Compound) for (t, _), r in zip(CASES, got)] == [(t, _compound(s)) for t, s in CASES]


def test_shares(spark):
    one, two, three, none = _score(spark, "the good soup", "good but very bad!", "zzz qqq", "")
    total = G + 1 + 2
    assert (one.Negative, one.Neutral, one.Positive) == (0.0, round(2 / total, 3), round((G + 1) / total, 3))
    pos, neg = 0.5 * G + 1, 1.5 * (-B + 0.293) + 1 + 0.292
    assert two.Negative == round(neg / (pos + neg + 2), 3) and two.Positive == round(pos / (pos + neg + 2), 3)
    assert tuple(three)[1:] == (0.0, 1.0, 0.0, 0.0) and tuple(none)[1:] == (0.0, 0.0, 0.0, 0.0)


WORDS = list(S.LEXICON)[:12] + S.NEGATORS[:4] + S.STRONGER[:2] + S.WEAKER[:2] + [
    "food", "the", "so", "this", "least", "at", "but", "kind", "of", "it's", "don't", "GOOD", "FOOD", "bad!", "?"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=12), min_size=1, max_size=30))
def test_both_lookups_agree(spark, texts):
    df = spark.createDataFrame([(str(i), " ".join(t)) for i, t in enumerate(texts)], ROWS)
    lex = spark.createDataFrame(sorted(S.LEXICON.items()), "token string, valence double")
    inline = {r.id: tuple(r)[1:] for r in S.sentiment(df, "text").collect()}
    joined = {r.id: tuple(r)[1:] for r in S.sentiment(df, "text", lex, inline_max=3).collect()}
    assert inline == joined
    for neg, neu, pos, comp in inline.values():
        assert -1 <= comp <= 1 and (neg + neu + pos == 0 or abs(neg + neu + pos - 1) < 2e-3)


def test_odd_rows(spark):
    """Null text, a repeated key, a null key and a token listed twice."""
    df = spark.createDataFrame([("1", None), ("2", "good food"), ("2", "not good at all"), (None, "bad soup"),
                                ("3", ""), ("4", "soup")], ROWS)
    lex = spark.createDataFrame([("good", 1.0), ("good", 3.0), ("bad", -2.0), (None, 1.0), ("soup", None)],
                                "token string, valence double")

    def rows(d):
        return sorted((tuple(r) for r in d.collect()), key=repr)
    inline = rows(S.sentiment(df, "text", lex))
    joined = rows(S.sentiment(df, "text", lex, inline_max=1))
    assert inline == joined == rows(S.sentiment(df, "text", {"good": 3.0, "bad": -2.0}))
    assert ("1", None, None, None, None) in inline and ("3", 0.0, 0.0, 0.0, 0.0) in inline and len(inline) == 6
    assert S.sentiment(df.limit(0), "text").collect() == []
    assert rows(S.sentiment(df, "text", {})) != inline


def test_plan_is_linear_in_the_text(spark):
    """Nothing of a row is computed again for each of its words, and the lookup is
    a folded literal."""
    df = spark.createDataFrame([("1", "good food")], ROWS)
    plan = S.sentiment(df, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and "from_json" not in plan and "slice(" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("inline_max", [S.INLINE_LEXICON_MAX, 1])
def test_long_text_costs_in_proportion(spark, inline_max):
    long = "not a very good soup but kind of bad food " * 20_000
    got, short = _score(spark, long, "good", inline_max=inline_max)
    assert got.Compound == -1.0 and got.Positive == 0.0 and short.Positive == 1.0


def test_read_and_learn_lexicons(spark, tmp_path):
    (tmp_path / "lexicon.txt").write_text('good\t1.9\t0.9\t[2, 2]\n:)\t2.0\t1\t[2]\n"odd\t-1.0\t0\t[]\nnothing\tx\t0\t[]\n')
    lex = S.read_lexicon(spark, str(tmp_path / "lexicon.txt"))
    assert sorted(map(tuple, lex.collect())) == [('"odd', -1.0), (":)", 2.0), ("good", 1.9)]
    assert _score(spark, "fine :)", lexicon=lex)[0].Compound == _compound(2.0)
    rated = [(5.0, "tasty soup, tasty tea")] * 8 + [(1.0, "cold Soup")] * 6 + [(2.0, "rare")] * 2 + [(None, "x"), (1.0, None)]
    d = spark.createDataFrame(rated, "ReviewStars double, Review string")
    got = {r.token: (r.valence, r.high, r.low) for r in S.rated_lexicon(d, least=3).collect()}
    h, low = 8 + 2, 8 + 2
    assert got["tasty"] == (round(math.log((9 / h) / (1 / low)), 2), 8, 0)
    assert got["cold"] == (round(math.log((1 / h) / (7 / low)), 2), 0, 6) and "rare" not in got
    assert got["soup"] == (round(math.log((9 / h) / (7 / low)), 2), 8, 6)
    assert S.rated_lexicon(d.limit(0)).collect() == []


def test_large_lexicon_is_learnt_once(spark, monkeypatch):
    """It is written before it is counted; the join reads the written table."""
    made = []
    table = S._token_table
    monkeypatch.setattr(S, "_token_table", lambda *a: made.append(1) or table(*a))
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("fine", 0.8)], "token string, valence double")
    df = spark.createDataFrame([(1, "not good, but fine"), (2, ""), (3, None)], "i int, text_ascii string")
    got = sorted(tuple(r) for r in S.sentiment(df, "text_ascii", lex, inline_max=1).collect())
    assert made == [1]
    assert got == sorted(tuple(r) for r in S.sentiment(df, "text_ascii", lex).collect())
