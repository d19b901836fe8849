"""Upserts that rewrite only the files they touch."""

import pathlib

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import merge_upsert
from strata.plans import load


def names(path):
    return {p.name for p in pathlib.Path(path).glob("*.parquet")}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def fifty(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("v"), F.lit("old").alias("s"))
    rows.repartitionByRange(50, "id").write.parquet(path)
    assert len(names(path)) == 50
    return path


def batch_of(spark, rows):
    return spark.createDataFrame(rows, "id long, v long, s string")


def test_three_of_fifty_files(spark, fifty):
    old, before = spark.read.parquet(fifty), names(fifty)
    batch = batch_of(spark, [(5, 1, "new"), (6, 2, "new"), (2500, 3, "new"), (4999, 4, "new")])
    want = rows_of(merge_upsert(old, batch, "id"))
    replaced = load.merge_files(spark, fifty, batch, "id")
    after = names(fifty)
    assert len(replaced) == 3 and len(before - after) == 3 and len(after - before) == 3
    assert rows_of(spark.read.parquet(fifty)) == want and not (pathlib.Path(fifty) / "_pending").exists()


def test_new_and_missing_keys_touch_nothing(spark, fifty):
    before = names(fifty)
    assert load.merge_files(spark, fifty, batch_of(spark, [(9000, 1, "n"), (None, 2, "n")]), "id") == []
    assert before < names(fifty) and spark.read.parquet(fifty).count() == 5002
    assert load.merge_files(spark, fifty, batch_of(spark, []), "id") == [] and spark.read.parquet(fifty).count() == 5002


def test_a_run_that_died_is_finished(spark, fifty, monkeypatch):
    old = spark.read.parquet(fifty)
    batch = batch_of(spark, [(5, 1, "new"), (7000, 3, "new")])
    want = rows_of(merge_upsert(old, batch, "id"))
    with monkeypatch.context() as m:
        calls = []
        finish = load.replace_files
        m.setattr(load, "replace_files", lambda *a: calls.append(1) or (finish(*a) if len(calls) == 1 else None))
        load.merge_files(spark, fifty, batch, "id")
    assert rows_of(spark.read.parquet(fifty)) == rows_of(old)
    load.replace_files(spark, fifty)
    assert rows_of(spark.read.parquet(fifty)) == want


def test_incomplete_files_are_forgotten(spark, fifty):
    spark.range(3).write.parquet(f"{fifty}/_pending/rows")
    assert load.merge_files(spark, fifty, batch_of(spark, [(1, 9, "new")]), "id") and spark.read.parquet(fifty).count() == 5000


def test_the_scan_for_files_reads_keys_in_range(spark, fifty, plan):
    target = spark.read.parquet(fifty)
    scan = target.select("id", "_metadata.file_path").filter(F.col("id").between(5, 9))
    text = plan(scan)
    assert "ReadSchema: struct<id:bigint>" in text and "GreaterThanOrEqual(id,5)" in text
