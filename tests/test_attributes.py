"""Attribute text as Python literals, against ast.literal_eval."""

import ast
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.functions import attributes as A

TEXT = st.text(st.characters(codec="utf-8", exclude_characters="\x00\x01\x02", exclude_categories=["Cs", "Cc"]) |
               st.sampled_from("'\"\\{}[],: \t\n"), max_size=12)
SCALAR = st.none() | st.booleans() | st.integers(-10**6, 10**6) | TEXT
VALUE = st.recursive(SCALAR, lambda v: st.lists(v, max_size=3) | st.dictionaries(TEXT, v, max_size=3) |
                     st.tuples(v, v), max_leaves=8)


def _json(spark, texts):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.j for r in d.select("i", A.literal_json(F.col("t")).alias("j")).orderBy("i").collect()]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.dictionaries(TEXT, VALUE, max_size=4), min_size=1, max_size=40))
def test_literals_are_read_like_python(spark, values):
    texts = [t for t in map(repr, values) if "\\U" not in t]
    for t, j in zip(texts, _json(spark, texts)):
        assert json.loads(j) == json.loads(json.dumps(ast.literal_eval(t))), t


def test_spelled_literals(spark):
    texts = [r"""{'a': u'it\'s', "b": "x, {y}: 'z'", 'c': '\x41\\n\t',}""", "{'n': [1, -2.5, (3, 4),], 5: None, True: 1}",
             r"{'d': '\d \a'}", "{'k': 'v\\", "{'a' True}", "{'a': open('x')}", "None", "", None, "{" + "'k': '" + "x" * 100_000 + "'}"]
    got = _json(spark, texts)
    for t, j in zip(texts[:3], got):
        want = json.loads(json.dumps({str(k).lower() if k is True else str(k): v for k, v in ast.literal_eval(t).items()}))
        assert json.loads(j) == want
    assert got[3] is None and json.loads(got[9])["k"] == "x" * 100_000
    d = spark.createDataFrame([(t,) for t in texts[3:6]], "t string")
    assert [r[0] for r in d.select(A.literal_variant(F.col("t")).isNull()).collect()] == [True, True, True]


def test_entries(spark):
    rows = [("{'romantic': False, 'casual': True}", "u'free'"), ("{'a, b': 'x}', 'q': \"it's\", 'n': {'m': 1}}", "'pa\"id'"),
            ("{'dessert': False, 'latenight' True}", "None"), (None, None), ("{}", "2")]
    d = spark.createDataFrame(rows, "f string, g string").select(F.struct("f", "g").alias("s"))
    got = [[(e.key, e.val) for e in r[0]] for r in d.select(A.attribute_entries(d, "s")).collect()]
    assert [sorted(x[:-1]) for x in got] == [
        [("f_casual", "TRUE"), ("f_romantic", "FALSE")],
        [("f_a, b", "X}"), ("f_n", '{"M":1}'), ("f_q", "IT'S")], [("f_dessert", "FALSE")], [("f", None)], []]
    assert [x[-1] for x in got] == [("g", "FREE"), ("g", 'PA"ID'), ("g", None), ("g", None), ("g", "2")]
    plan = d.select(A.attribute_entries(d, "s"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
