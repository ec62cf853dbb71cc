"""Registered queries: contracts, SQL twins at sf0.001, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from revlens.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute

CONTRACT = {
    "op1_": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op2_": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op3_": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
             "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op7_": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op9_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op10_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op12_": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op13_": {"word": "string", "n": "bigint", "n_near": "bigint", "form": "string", "form_n": "bigint", "root": "string"},
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_registered():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, len(QUERIES) + 1)}
    assert set(E.queries()) >= {*QUERIES, "pipeline"} and set(E.oracle_sql()) >= set(ORACLE)


def _key(row):
    return repr(tuple(row))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    want = con.sql(ORACLE[key])
    assert sorted(want.columns) == cols
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
    assert got == sorted(want.project(", ".join(cols)).fetchall(), key=_key)
    _check_contract(key, df)


def _check_contract(key, df):
    types = dict(df.dtypes)
    for prefix, want in CONTRACT.items():
        if key.startswith(prefix):
            assert {c: types.get(c) for c in want} == want


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_contract(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    _check_contract(key, df)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert sorted(r.doc_id for r in df.select("doc_id").collect()) == sorted(r.doc_id for r in docs.collect())


@pytest.mark.parametrize("key,label,least", [("op9", "quality", 0.9), ("op10", "toxic", 0.85)])
def test_held_out_accuracy(spark, key, label, least):
    name = next(k for k in QUERIES if k.startswith(key + "_"))
    sf = SF_SMALL.replace("0.001", "0.1")
    out = QUERIES[name](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r[label] for r in out) / len(out) >= least
    clean = [r for r in out if r[label] == (1 if label == "quality" else 0)]
    assert sum(r.predicted == r[label] for r in clean) / len(clean) >= 0.99


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = QUERIES["op7_word_first_language"](spark, SF_SMALL).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) / len(out) >= 0.98


def test_pipeline_stages(spark):
    """Each stage against brute force on what the one before it kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    columns, kept = docs.columns, [docs]
    for name, stage in C.STAGES:
        kept.append(C.persist_cut(stage(spark, kept[-1], SF_SMALL), spark, "test"))
    assert all(d.columns == columns for d in kept[:-1])
    rows = [{r.doc_id: r for r in d.collect()} for d in kept]
    good = {r.doc_id: r.predicted for r in QUERIES["op9_line_crf_quality"](spark, SF_SMALL).collect()}
    assert set(rows[1]) == {i for i, p in good.items() if p == 1}
    lines = brute.without_lines([(r.doc_id, r.source, r.text) for r in rows[1].values()], 10)
    assert {i: r.text for i, r in rows[2].items()} == lines
    near = brute.classes([(i, r.text) for i, r in rows[2].items()], 5, 80)
    assert set(rows[3]) == {i for i, (_, c) in near.items() if c == i}
    found = {d for d, *_ in brute.contained([(i, r.text) for i, r in rows[3].items()], items, 80)}
    assert set(rows[4]) == set(rows[3]) - found
    assert {i: r.decoded_sha256 for i, r in rows[5].items()} == {
        i: brute.sha((r.text or "").encode()) for i, r in rows[4].items()}
