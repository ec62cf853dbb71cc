"""Pipeline stages on odd tables: nulls, empty texts, repeated rows, further columns, no rows."""

import pytest

import corpus_pipeline as C
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, gone_places long"


@pytest.fixture(scope="module")
def odd(spark):
    real = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").limit(60).collect()]
    rows = [(*r, "x", 1) for r in real] + [(*real[0], "x", 1)] * 2
    rows += [(10**6, None, None, None, None, None, None), (10**6 + 1, "", "", "", 0, "", 0),
             (10**6 + 2, " \n\t", "en", "s", 3, "y", 2), (None, "no id at all", "en", "s", 12, "y", 2),
             (10**6 + 3, "word " * 150_000, "en", "s", 750_000, "y", 2)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name,stage", C.STAGES[:-1])
def test_filtering_stages(spark, odd, name, stage):
    out = stage(spark, odd, SF_SMALL)
    assert out.columns == odd.columns
    got = out.collect()
    known = {(r.doc_id, r.source, r.component_id) for r in odd.collect()}
    assert {(r.doc_id, r.source, r.component_id) for r in got} <= known and len(got) <= odd.count()
    assert stage(spark, odd.limit(0), SF_SMALL).collect() == []


def test_last_stage(spark, odd):
    out = C.STAGES[-1][1](spark, odd, SF_SMALL)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == odd.count() and got[10**6].n_tokens == got[10**6 + 1].n_tokens == 0
    assert got[10**6].decoded_sha256 == got[10**6 + 1].decoded_sha256
    assert C.STAGES[-1][1](spark, odd.limit(0), SF_SMALL).collect() == []
