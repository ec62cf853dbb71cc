"""Sources and sinks: explicit-schema scans, header stripping, bounded sinks, lineage cuts."""

import json
import os

import pytest

from revlens import schemas
from revlens.operators.joins import broadcast_if_small, planned_bytes, take_bounded
from revlens.session import shared_dir
from revlens.sources import io


def test_read_json_with_schema(spark, tmp_path):
    p = tmp_path / "chk.json"
    p.write_text("\n".join(json.dumps(r) for r in [{"business_id": "a", "date": "2020-01-01 00:00:00"},
                                                      {"business_id": "b", "extra": 1}]))
    df = io.read_json(spark, str(p), schemas.CHECKIN_RAW)
    assert df.columns == ["business_id", "date"]
    assert sorted((r.business_id, r.date) for r in df.collect()) == [("a", "2020-01-01 00:00:00"), ("b", None)]


def test_csv_strings_and_strip(spark, tmp_path):
    p = tmp_path / "lookup.csv"
    p.write_text(" Neighbourhood , Total Population\nNorth,12\n")
    df = io.strip_header(io.read_csv_strings(spark, str(p)))
    assert df.columns == ["Neighbourhood", "Total Population"]
    assert df.schema["Total Population"].dataType.simpleString() == "string"


def test_sinks(spark, tmp_path):
    df = spark.range(5).selectExpr("id", "id * 2 AS twice")
    io.write_table(df, str(tmp_path / "t"), "parquet")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    io.write_small_csv(df, str(tmp_path / "one"), max_rows=5)
    assert len([f for f in os.listdir(tmp_path / "one") if f.endswith(".csv")]) == 1
    with pytest.raises(ValueError):
        io.write_small_csv(df, str(tmp_path / "two"), max_rows=4)


def test_persist_cut_in_shared_folder(spark):
    df = spark.range(10).selectExpr("id % 3 AS k").groupBy("k").count()
    cut = io.persist_cut(df, spark, "unit")
    assert sorted(tuple(r) for r in cut.collect()) == [(0, 4), (1, 3), (2, 3)]
    # the plan of the cut starts from the written table, not from range()
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Range" not in plan
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_bounded_helpers(spark):
    df = spark.range(100)
    assert planned_bytes(df) <= 100 * 8
    assert "BroadcastExchange" in broadcast_if_small(df, 800).join(df, "id")._jdf.queryExecution() \
        .executedPlan().toString()
    with pytest.raises(ValueError):
        take_bounded(df, 10)
    assert len(take_bounded(df, 100)) == 100


def _ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_staged_write_replaces_as_a_whole(spark, tmp_path):
    dest = str(tmp_path / "t")
    assert io.write_staged(spark.range(3), dest) == 3 and _ids(spark, dest) == [0, 1, 2]
    # the new table may be made from the old one, and have other columns
    io.write_staged(spark.read.parquet(dest).selectExpr("id + 1 AS id", "'x' AS more"), dest)
    assert _ids(spark, dest) == [1, 2, 3] and os.listdir(tmp_path) == ["t"]
    io.write_table(spark.range(4).selectExpr("id", "id % 2 AS k"), dest, partition_by=["k"])
    assert _ids(spark, dest) == [0, 1, 2, 3] and io.write_staged(spark.range(0), dest) == 0


@pytest.mark.parametrize("fails", [1, 2])
def test_staged_write_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch, fails):
    """The job ends before the first or between the two renames."""
    dest, real, calls = str(tmp_path / "t"), io._rename, []
    io.write_staged(spark.range(3), dest)

    def rename(*a):
        calls.append(a)
        if len(calls) == fails:
            raise OSError("lost")
        real(*a)
    monkeypatch.setattr(io, "_rename", rename)
    with pytest.raises(OSError):
        io.write_staged(spark.range(10, 12), dest)
    monkeypatch.setattr(io, "_rename", real)
    io.recover_table(spark, dest)
    assert _ids(spark, dest) == [0, 1, 2]
    io.write_staged(spark.range(10, 12), dest)  # the rerun
    assert _ids(spark, dest) == [10, 11]


def test_staged_write_checks_before_it_replaces(spark, tmp_path):
    dest = str(tmp_path / "t")
    io.write_staged(spark.range(3), dest)

    def check(t):
        if t.count() < 100:
            raise ValueError("too few rows")
    with pytest.raises(ValueError):
        io.write_staged(spark.range(5), dest, check=check)
    with pytest.raises(Exception):
        io.write_staged(spark.range(5).selectExpr("assert_true(id < 4) AS x"), dest)
    assert _ids(spark, dest) == [0, 1, 2] and os.listdir(tmp_path) == ["t"]


def test_derived_folders_follow_their_inputs(spark, tmp_path):
    src = str(tmp_path / "in")
    io.write_staged(spark.range(3), src)
    path, there = io.stored(spark, "unit", [src], 1)
    assert not there and io.stored(spark, "unit", [src], 2)[0] != path
    io.write_staged(spark.range(1), path)
    io.release_cuts(spark)
    assert io.stored(spark, "unit", [src], 1) == (path, True)
    io.write_staged(spark.range(4), src)
    assert io.stored(spark, "unit", [src], 1)[1] is False


def test_quarantine_of_malformed_lines(spark, tmp_path):
    good = [{"review_id": f"r{i}", "stars": 4.5, "cool": i, "text": "a\nb"} for i in range(20)] + [{"review_id": None}, {}]
    lines = [json.dumps(r) for r in good]
    broken = ['{"review_id": "x", "sta', "no json at all", '[1, 2]', '"text"', "7"]
    wrong = ['{"review_id": "y", "stars": "many"}', '{"review_id": "z", "cool": [1]}', '{"review_id": "w", "cool": 1.5}']
    for name, part in (("a.json", lines[:10] + broken), ("b.json", lines[10:] + ["", "   "] + wrong)):
        (tmp_path / name).write_text("\n".join(part) + "\n")
    ok, bad, counts = io.read_json_checked(spark, str(tmp_path), schemas.REVIEW_RAW)
    assert counts == {"lines": 30, "good": 22, "quarantined": 8}
    assert ok.schema == schemas.REVIEW_RAW and sorted(r.cool for r in ok.collect() if r.cool is not None) == list(range(20))
    got = {r.record: (os.path.basename(r.file), r.reason) for r in bad.collect()}
    assert got == {**{x: ("a.json", "not JSON") for x in broken}, **{x: ("b.json", "wrong type") for x in wrong}}
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.json").write_text("")
    assert io.read_json_checked(spark, str(tmp_path / "none"), schemas.REVIEW_RAW)[2] == {
        "lines": 0, "good": 0, "quarantined": 0}
