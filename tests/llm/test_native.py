"""Quality rules, line deduplication and revisits: JVM built-ins against plain Python."""

import random

import pytest

from revlens.llm.lines import boilerplate, remove_boilerplate
from revlens.llm import rules
from revlens.llm.rules import quality_rules
from revlens.llm.warc import resolve_revisits
from tests.llm import brute

TEXTS = [None, "", " \n\t\n", "a", "a b", "a b c", "a a a", "a a a a", "a b c a b c", "x\ny\nx\n \n \nz\ny",
         "1 2 3 4 1 2 3 9 9 9 9", "é ß # $ <tag> |", "the same line\nthe same line", "\x1c\x85 a b", "r " * 500]


def _no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_base_rules_equal_brute_force(spark):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("abcd") + rng.choice(["", "", "\n"]) for _ in range(rng.randrange(80)))
                     for _ in range(60)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = quality_rules(d, d.where("doc_id < 5"))
    assert _no_python(out)
    for r in out.collect():
        n, chars, symbols, dup, rep = brute.base_rules(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert r.kept <= (not r.base_failed)


def test_rules_hold_no_weights_in_rows_and_index_no_words(spark):
    """65,536 weights copied for every row, and words read by index in lambdas, took half the time."""
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = quality_rules(d, d)._jdf.queryExecution().executedPlan().toString()
    assert " AS weights#" not in plan and "sequence(" not in plan


def test_repeated_words_of_long_texts(spark):
    """Windows found twice far apart, side by side and never, at lengths about powers of two."""
    rng = random.Random(4)
    texts = [" ".join(f"{i}.{k}" for k in range(n)) + f"\t{i}.0 {i}.1\r\n{i}.2 x" * (i % 3)
             for i, n in enumerate((61, 62, 63, 64, 65, 66, 67, 4095, 4096, 4097))]
    texts += [" ".join(str(rng.randrange(k)) for _ in range(20_000)) for k in (2, 20, 90, 10_000)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules(d, d.limit(0)).collect():
        n, chars, _, _, rep = brute.base_rules(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (n, chars, rep)


def test_rules_reject_what_the_target_lacks(spark):
    rng = random.Random(2)
    good = [" ".join(f"w{rng.randrange(40)}" for _ in range(200)) for _ in range(40)]
    bad = [" ".join(f"w{rng.randrange(40)}### JUNK{rng.randrange(40)}" for _ in range(100)) for _ in range(20)]
    d = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    out = {r.doc_id: r for r in quality_rules(d, d.where("doc_id < 30")).collect()}
    assert all(out[i].kept for i in range(40)) and not any(out[i].kept for i in range(40, 60))
    assert all(not out[i].base_failed for i in range(60))


@pytest.mark.parametrize("broadcast_ids", [500_000, 0])
def test_every_trusted_document_counts(spark, monkeypatch, broadcast_ids):
    """A target that is the corpus itself weighs nothing, however large."""
    monkeypatch.setattr(rules, "BROADCAST_IDS", broadcast_ids, raising=False)
    d = spark.range(25_000).selectExpr("id AS doc_id", "concat('w', id, ' v', id) AS text")
    assert set(rules.slot_weights(d, d).first().weights) == {0.0}


def test_rules_of_odd_tables(spark):
    schema = "doc_id long, text string, w int, weights string, score int"
    empty = spark.createDataFrame([], schema)
    assert quality_rules(empty, empty).collect() == []
    d = spark.createDataFrame([(None, "a", 1, "x", 1), (1, "a", 1, "x", 1), (1, "a", 1, "x", 1)], schema)
    assert quality_rules(d, d.limit(0)).count() == 3  # no trusted document, repeated rows, null id


def _line_docs(seed):
    rng = random.Random(seed)
    common = [f"common line {k}" for k in range(12)]
    rows = [(0, "s0", None), (1, "s1", ""), (2, None, common[0] + "\nown"), (3, "s3", "\n\n" + common[1] + "\n")]
    for i in range(4, 120):
        lines = [common[k] for k in range(12) if rng.random() < (k + 1) / 14] + [f"own {i} {rng.randrange(5)}", " ", ""]
        rng.shuffle(lines)
        rows.append((i, f"s{rng.randrange(9)}", "\n".join(lines)))
    return rows


@pytest.mark.parametrize("min_sites", [1, 5, 8, 20])
def test_lines_equal_brute_force(spark, min_sites):
    rows = _line_docs(min_sites)
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = remove_boilerplate(d, min_sites)
    assert _no_python(out)
    got = {r.doc_id: r.text for r in out.collect()}
    want = brute.without_lines(rows, min_sites)
    # a text all of whose lines go is an empty text
    assert got == want
    for r in out.collect():
        n = len([x for x in (rows[r.doc_id][2] or "").split("\n") if brute.words(x)])
        assert r.n_lines == n


def test_near_threshold_lines_are_counted(spark):
    """1,000 sites around a threshold of 1,000: the sketch alone would err."""
    rows = [(s, f"site{s}", "\n".join(f"line {n}" for n in (990, 999, 1000, 1001, 1010) if s < n)) for s in range(1010)]
    d = spark.createDataFrame(rows, "doc_id long, site string, text string")
    assert boilerplate(d, 1000).count() == 3


def test_lines_of_odd_tables(spark):
    schema = "doc_id long, source string, text string, place int, n_lines string, gone int"
    assert remove_boilerplate(spark.createDataFrame([], schema)).collect() == []
    d = spark.createDataFrame([(1, "a", "x\ny", 1, "q", 2), (1, "a", "x\ny", 1, "q", 2), (None, "b", "x", 1, "q", 2)],
                              schema)
    out = remove_boilerplate(d, 2)
    assert out.columns == ["doc_id", "source", "text", "place", "gone", "n_lines", "n_removed"]
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == [("1", "y"), ("1", "y"), ("None", "x")]


HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nETag: {0}\r\nX-Old: 1\r\nCache-Control: a\r\nContent-Length: 9"
REC = "record_id long, warc_type string, target_uri string, warc_date string, http_headers string, payload string"


def _revisits(spark, rows):
    return {r.record_id: r for r in resolve_revisits(spark.createDataFrame(rows, REC)).collect()}


def test_revisits(spark):
    def asked(i, url, date, head):
        return (i, "Revisit", url, date, f"HTTP/1.1 304 Not Modified\r\n{head}", None)

    rows = [
        (1, "response", "http://www.A.com:80/p/?utm_x=1&b=2&a=1#f", "2024-01-01T00:00:00Z", HEAD.format('W/"1"'), "one"),
        (2, "response", "https://a.com/p?a=1&b=2", "2024-01-02T00:00:00Z", HEAD.format('"2"'), "two"),
        (3, "response", "https://a.com/p?a=1&b=2", "2024-01-03T00:00:00Z", "HTTP/1.1 404 Not Found", "gone"),
        (4, "response", "https://a.com/q", "2024-01-03T00:00:00Z", "HTTP/1.1 200 OK", None),
        asked(10, "https://a.com/p?b=2&a=1", "2024-01-01T12:00:00Z", 'etag: "1"\r\nCache-Control: b\r\nContent-Length: 0'),
        asked(11, "https://a.com/p?b=2&a=1", "2024-01-05T00:00:00Z", 'ETag: "1"'),
        asked(12, "https://a.com/p?b=2&a=1", "2023-01-05T00:00:00Z", 'ETag: "1"'),
        asked(13, "https://a.com/p?b=2&a=1", "no date", 'ETag: "1"'),
        asked(14, None, "2024-01-05T00:00:00Z", 'ETag: "1"'),
        asked(15, "https://a.com/q", "2024-01-03T00:00:00Z", "X: 1"),
        asked(16, "https://a.com/other", "2024-01-03T00:00:00Z", "X: 1"),
        (17, "revisit", "https://a.com/q", "2024-01-03T00:00:00Z", None, None),
        (None, "revisit", "https://a.com/q", "2024-01-03T00:00:00Z", "HTTP/1.1 304 x", None),
    ]
    got = _revisits(spark, rows)
    assert {i: (r.response_id, r.outcome) for i, r in got.items()} == {
        10: (1, "resolved"), 11: (2, "validator_mismatch"), 12: (None, "no_response"), 13: (None, "no_key"),
        14: (None, "no_key"), 15: (4, "resolved"), 16: (None, "no_response")}
    assert got[10].payload == "one" and got[11].payload is None and got[15].payload is None
    assert got[10].http_headers.split("\r\n") == [
        "HTTP/1.1 200 OK", "content-type: text/html", "x-old: 1", "content-length: 9", 'etag: "1"', "cache-control: b"]
    assert _revisits(spark, rows[:0] + rows[:4]) == {}


def test_revisits_of_one_hot_url(spark):
    """One URL, many captures over days and within one second."""
    rng = random.Random(3)
    rows, full = [], []
    for i in range(1500):
        at = rng.choice([0, 0, rng.randrange(86400 * 3)])
        date = f"2024-01-{1 + at // 86400:02d}T{at % 86400 // 3600:02d}:{at % 3600 // 60:02d}:{at % 60:02d}Z"
        if rng.random() < 0.2:
            full.append((at, i))
            rows.append((i, "response", "http://h/x", date, 'HTTP/1.1 200 OK\r\nETag: "e"', f"body {i}"))
        else:
            rows.append((i, "revisit", "http://h/x/", date, 'HTTP/1.1 304 Not Modified\r\nETag: "e"', None))
    times = {i: (at, i) for at, i in full}
    got = _revisits(spark, rows)
    for r in rows:
        if r[1] == "revisit":
            d = r[3]
            at = (int(d[8:10]) - 1) * 86400 + int(d[11:13]) * 3600 + int(d[14:16]) * 60 + int(d[17:19])
            before = [t for t in times.values() if t < (at, r[0])]
            assert got[r[0]].response_id == (max(before)[1] if before else None)


def test_fields_far_down_a_head_are_seen(spark):
    """The validator and a field to merge stand after 100,000 others."""
    many = "".join(f"X-{i}: {i}\r\n" for i in range(100_001))
    rows = [(1, "response", "http://a.org/", "2024-01-01T00:00:00Z", f'HTTP/1.1 200 OK\r\n{many}ETag: "e"\r\nAge: 1', "body"),
            (2, "revisit", "http://a.org/", "2024-01-02T00:00:00Z", 'HTTP/1.1 304 Not Modified\r\nETag: "e"\r\nAge: 2', None)]
    r = _revisits(spark, rows)[2]
    assert (r.outcome, r.payload) == ("resolved", "body")
    lines = r.http_headers.split("\r\n")
    assert len(lines) == 100_004 and "x-100000: 100000" in lines and lines[-2:] == ['etag: "e"', "age: 2"]


def test_revisits_given_twice(spark):
    """A file read twice: one row for each revisit row, further columns ignored."""
    rows = [(1, "response", "http://a.org/", "2024-01-01T00:00:00Z", 'HTTP/1.1 200 OK\r\nETag: "e"', "body"),
            (2, "revisit", "http://a.org/", "2024-01-02T00:00:00Z", 'HTTP/1.1 304 Not Modified\r\nETag: "e"', None)] * 2
    d = spark.createDataFrame(rows, REC).selectExpr("*", "'x' AS url", "1 AS at", "2 AS response_id")
    got = resolve_revisits(d).collect()
    assert [(r.record_id, r.response_id, r.outcome, r.payload) for r in got] == [(2, 1, "resolved", "body")] * 2
    assert resolve_revisits(d.limit(0)).collect() == []


def test_lines_beside_columns_of_like_names(spark):
    rows = [(i, f"s{i}", "common line\nown " + str(i), "x", "y", i) for i in range(3)]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string, gone_places string, Gone_Places_ string, gone_id long")
    out = remove_boilerplate(d, 2)
    assert out.columns == [*d.columns, "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.text, r.gone_places, r.n_removed) for r in out.collect()) == [
        (i, f"own {i}", "x", 1) for i in range(3)]
