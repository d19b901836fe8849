"""Loads of files with lines and values that are wrong."""

import json

import pytest
from pyspark.sql import types as T

from strata import sources as S
from strata.operators.align import staging_like
from strata.operators.watermarks import STATE_SCHEMA
from strata.plans.load import RejectedLines, load_files, stage_files
from strata.specs import LoadSpec

SCHEMA = (
    T.StructType()
    .add("id", T.LongType())
    .add("o", T.StructType().add("n", T.LongType()).add("s", T.StringType()).add("at", T.TimestampNTZType()))
    .add("a", T.ArrayType(T.LongType()))
    .add("m", T.MapType(T.StringType(), T.DateType()))
    .add("d", T.DoubleType())
    .add("unused", T.StringType())
)
LINES = [
    '{"id": 1, "o": {"n": 5, "s": "x", "at": "2024-01-02T03:04:05"}, "a": [1, 2], "m": {"k": "2024-01-01"}, "d": 1.5}',
    '{"id": 2, "o": {"n": "abc", "s": 7, "at": null}, "a": [1, "b", 3], "m": {"k": "x", "l": "2024-01-01"}, "d": "2.5"}',
    '{"id": 3, "o": {"n": 4.5}, "a": "no", "m": [1], "d": true}',
    "not json",
    "   ",
    '{"id": 4, "d": 2',
    "[1, 2]",
    '{"id": "x5", "o": null, "a": null, "extra": 1}',
]
SPEC = LoadSpec("events", "raw", "events", ("id",), incremental_strategy="timestamp")


@pytest.fixture()
def path(tmp_path):
    file = tmp_path / "in.ndjson"
    file.write_text("\n".join(LINES) + "\n")
    return str(file)


def test_values_are_judged_one_by_one(spark, path):
    rows = {r.id: r for r in S.read_ndjson_tolerant(spark, path, SCHEMA).collect()}
    assert set(rows) == {1, 2, 3, None}
    assert rows[1].o.at.isoformat() == "2024-01-02T03:04:05" and rows[1].a == [1, 2]
    assert (rows[2].o.n, rows[2].o.s, rows[2].a, rows[2].d) == (None, "7", [1, None, 3], 2.5)
    assert rows[2].m["k"] is None and rows[2].m["l"].isoformat() == "2024-01-01"
    assert (rows[3].o.n, rows[3].a, rows[3].m, rows[3].d) == (None, None, None, None)
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|FAILED_READ"):
        S.read_ndjson(spark, path, SCHEMA).collect()


def test_wrong_nested_values_do_not_fail_a_strict_reading(spark, tmp_path):
    file = tmp_path / "in.ndjson"
    file.write_text("\n".join(LINES[:3]))
    assert S.read_ndjson(spark, str(file), SCHEMA).count() == 3


def test_rejects_are_counted_and_kept(spark, path):
    batch = stage_files(spark, path, SCHEMA)
    assert batch.counts == {"lines": 7, "malformed": 3, "rejected": 6, "wrong:id": 1, "wrong:o": 2, "wrong:a": 2, "wrong:m": 2, "wrong:d": 1}
    assert batch.rows.columns == ["id", "o", "a", "m", "d"] and batch.rows.count() == 4
    rejects = {r.line: r for r in batch.rejects.collect()}
    assert set(rejects) == set(LINES[1:4] + LINES[5:]) and all(r.file.endswith("in.ndjson") for r in rejects.values())
    assert rejects["not json"].columns == [] and rejects[LINES[2]].columns == ["o", "a", "m", "d"]


def test_a_load_raises_before_anything_is_merged(spark, path, tmp_path):
    target, state, kept = staging_like(spark, SCHEMA), staging_like(spark, STATE_SCHEMA), str(tmp_path / "kept")
    with pytest.raises(RejectedLines, match="6 of 7 lines rejected") as raised:
        load_files(path, target, SPEC, state, "2024-01-31", rejects_folder=kept)
    assert raised.value.counts["malformed"] == 3
    with pytest.raises(RejectedLines):
        load_files(path, target, SPEC, state, "2024-01-31", tolerate=5)
    result = load_files(path, target, SPEC, state, "2024-02-01", tolerate=6, rejects_folder=kept)
    stats = result.stats.first()
    assert (stats.total_raw, stats.pk_missing, stats.malformed) == (7, 1, 3) and stats.wrong_values["o"] == 2
    assert result.target.count() == 4 and result.rejects.count() == 6
    assert {(r.load, str(r.run_ts)[:10], r["count"]) for r in spark.read.parquet(kept).groupBy("load", "run_ts").count().collect()} == {
        ("events", "2024-01-31", 6), ("events", "2024-02-01", 6)
    }


def test_clean_files_have_no_rejects(spark, tmp_path):
    file = tmp_path / "clean.ndjson"
    file.write_text("\n".join(json.dumps({"id": i, "d": i / 2}) for i in range(5)))
    result = load_files(str(file), staging_like(spark, SCHEMA), SPEC, staging_like(spark, STATE_SCHEMA), "2024-01-31")
    assert result.stats.first().malformed == 0 and result.stats.first().wrong_values == {} and result.rejects.count() == 0


def test_csv(spark, tmp_path):
    schema = T.StructType.fromDDL("id bigint, name string, d double")
    (tmp_path / "in.csv").mkdir()
    (tmp_path / "in.csv" / "a.csv").write_text('ID,x,d\n1,a,2.5\n2,"q, r",zz\n3\n4,a,1,9\n\n5,,\n')
    (tmp_path / "in.csv" / "b.csv").write_text("d,id,name\n1,6,six\n")
    batch = stage_files(spark, str(tmp_path / "in.csv"), schema)
    assert batch.counts == {"lines": 6, "malformed": 2, "rejected": 3, "wrong:d": 1}
    assert sorted((r.id, r.name, r.d) for r in batch.rows.collect()) == [(1, None, 2.5), (2, None, None), (5, None, None), (6, "six", 1.0)]
    assert sorted((r.line, r.columns) for r in batch.rejects.collect()) == [('2,"q, r",zz', ["d"]), ("3", []), ("4,a,1,9", [])]


def test_a_kind_that_is_unknown(spark, path):
    with pytest.raises(ValueError, match="ndjson or csv"):
        stage_files(spark, path, SCHEMA, "xml")
