"""Reports, state and history that are kept up without rewriting what stays."""

import dataclasses
import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.align import staging_like
from strata.operators.history import snapshot_check, snapshot_timestamp
from strata.operators.merge import merge_upsert
from strata.operators.watermarks import STATE_SCHEMA
from strata.plans import load, star
from strata.plans.snapshots import extend_history, read_history
from strata.plans.state import read_state, write_state
from strata.sources import materialize
from strata.specs import LoadSpec


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Reports


@pytest.mark.parametrize("seed", range(4))
def test_a_report_is_what_a_rebuild_gives(spark, tmp_path, seed):
    rng = random.Random(seed)
    day = lambda: rng.choice([None, *[dt.date(2024, 1, k) for k in range(1, 12)]])
    row = lambda i: (i, day(), rng.choice("ab"), rng.randrange(5))
    before = spark.createDataFrame([row(i) for i in range(120)], "id long, date_day date, kind string, user int")
    batch = spark.createDataFrame([row(i) for i in [*rng.sample(range(120), 6), 500, 501]], before.schema)
    by, metrics = ["date_day", "kind"], {"users": F.count_distinct("user")}
    merge_upsert(before, batch, "id").write.partitionBy("date_day").parquet(f"{tmp_path}/wide")
    wide = spark.read.parquet(f"{tmp_path}/wide")
    periods = star.touched_periods(before, batch, "id", "date_day")
    assert 0 < len(periods) < 12
    got = star.report_incremental(star.report_rollup(before, by, metrics), wide, periods, by, metrics, "date_day")
    assert rows_of(got) == rows_of(star.report_rollup(wide, by, metrics))


def test_the_scan_is_pruned_to_the_periods(spark, tmp_path, plan):
    rows = spark.range(100).selectExpr("id", "DATE '2024-01-01' + CAST(id % 10 AS INT) AS date_day", "'a' AS kind")
    rows.write.partitionBy("date_day").parquet(f"{tmp_path}/wide")
    wide = spark.read.parquet(f"{tmp_path}/wide")
    wanted = wide.filter(star.in_periods(wide, "date_day", [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]))
    assert len({r.f for r in wanted.select(F.input_file_name().alias("f")).collect()} - {""}) <= 2 * rows.rdd.getNumPartitions()
    text = plan(wanted)
    assert "date_day" in text[text.index("PartitionFilters") :].split("\n")[0] and wanted.count() == 20
    with pytest.raises(ValueError, match="reach over"):
        star.report_incremental(wide, wide, [], ["kind"], {}, "date_day")


# State and targets of loads that run at once

SPEC = LoadSpec("t", "raw", "t", ("id",), incremental_strategy="timestamp", incremental_column="at")


@pytest.fixture()
def tables(spark, tmp_path):
    made = []

    def table(name):
        full = f"upkeep_{name}_{tmp_path.name}".replace("-", "_")
        load.publish(spark.createDataFrame([(1, "old", "2024-01-01")], "id long, v string, at string"), full, f"{tmp_path}/{full}")
        made.append(full)
        return full

    yield table
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch_of(spark, value, at):
    return spark.createDataFrame([(1, value, at), (2, value, at)], "id long, v string, at string")


def test_loads_of_two_tables_at_once_keep_both_states(spark, tmp_path, tables):
    a, b, state = tables("a"), tables("b"), f"{tmp_path}/state"
    other = dataclasses.replace(SPEC, name="u", target_table="u")

    def extract(spark, spec, start, end):
        # The other load begins and ends while this one runs.
        load.execute_load(spark, other, lambda *_: batch_of(spark, "other", "2024-01-09"), b, state, str(tmp_path), "2024-01-31 01:00:00")
        return batch_of(spark, "mine", "2024-01-05")

    result = load.execute_load(spark, SPEC, extract, a, state, str(tmp_path), "2024-01-31 02:00:00")
    assert result.status == "success" and result.state.count() == 1
    rows = {r.target_table: (r.watermark_value, r.status) for r in read_state(spark, state).collect()}
    assert rows == {"t": ("2024-01-05", "success"), "u": ("2024-01-09", "success")}
    assert {r.v for r in spark.table(a).collect()} == {"mine"} and {r.v for r in spark.table(b).collect()} == {"other"}


def test_a_target_that_moved_is_left_alone(spark, tmp_path, tables):
    a, state = tables("a"), f"{tmp_path}/state"

    def extract(spark, spec, start, end):
        load.execute_load(spark, SPEC, lambda *_: batch_of(spark, "first", "2024-01-09"), a, state, str(tmp_path), "2024-01-31 01:00:00")
        return batch_of(spark, "second", "2024-01-05")

    with pytest.raises(load.MovedTarget):
        load.execute_load(spark, SPEC, extract, a, state, str(tmp_path), "2024-01-31 02:00:00")
    spark.catalog.refreshTable(a)
    assert {r.v for r in spark.table(a).collect()} == {"first"}
    (row,) = read_state(spark, state).collect()
    assert row.status == "failed" and row.watermark_value == "2024-01-09"


def test_state_replaces_own_partition_only(spark, tmp_path):
    path = f"{tmp_path}/state"
    assert read_state(spark, path).count() == 0
    keys = "layer string, target_schema string, target_table string, watermark_value string"
    write_state(spark.createDataFrame([("raw", "7", "01", "a"), ("raw", "7", "x/y=z", "b")], keys), path)
    files = {p.name for p in pathlib.Path(path).rglob("*.parquet")}
    write_state(spark.createDataFrame([("raw", "7", "01", "c")], keys), path)
    assert {(r.target_schema, r.target_table, r.watermark_value) for r in read_state(spark, path).collect()} == {("7", "01", "c"), ("7", "x/y=z", "b")}
    assert len(files & {p.name for p in pathlib.Path(path).rglob("*.parquet")}) == 1
    assert read_state(spark, path).schema == staging_like(spark, STATE_SCHEMA).schema


def test_a_model_may_read_its_own_table(spark, tmp_path):
    name = f"own_{tmp_path.name}".replace("-", "_")
    first = materialize(spark.range(3), name, "table", folder=str(tmp_path))
    again = materialize(first.selectExpr("id + 10 AS id"), name, "table", folder=str(tmp_path))
    assert rows_of(again) == [(10,), (11,), (12,)]
    with pytest.raises(ValueError):
        materialize(spark.range(3), name, "table", partition_by=["id"], folder=str(tmp_path))
    spark.sql(f"DROP TABLE {name}")


# History


def looks(rng, n=6):
    rows = {i: (i, rng.choice("ab"), dt.datetime(2024, 1, 1)) for i in range(30)}
    for k in range(n):
        yield dt.datetime(2024, 1, 2 + k), list(rows.values())
        for i in rng.sample(range(35), 8):
            rows[i] = (i, rng.choice("abc"), dt.datetime(2024, 1, 2 + k, 12))
        rows.pop(rng.choice(list(rows)))


@pytest.mark.parametrize("by_time", [True, False])
def test_history_in_parts_is_the_same_history(spark, tmp_path, by_time):
    folder, whole, closed = str(tmp_path / "h"), None, {}
    assert read_history(spark, folder) is None
    for at, rows in looks(random.Random(by_time)):
        source = spark.createDataFrame(rows, "id long, v string, at timestamp_ntz")
        if by_time:
            whole = snapshot_timestamp(whole, source, "id", "at", at, True)
        else:
            whole = snapshot_check(whole, source, "id", ["v"], at, True)
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        got = extend_history(spark, folder, source, "id", at, updated_at="at" if by_time else None, check_columns=None if by_time else ["v"], hard_deletes=True)
        assert rows_of(got.select(whole.columns)) == rows_of(whole)
        now = {p: p.stat().st_mtime_ns for p in pathlib.Path(folder, "closed").rglob("*.parquet")}
        assert closed.items() <= now.items()
        closed = now
    assert closed and len(list(pathlib.Path(folder, "open").iterdir())) == 2


def test_a_run_that_died_is_as_if_it_had_not_been(spark, tmp_path):
    folder = str(tmp_path / "h")
    source = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], "id long, v string, at timestamp_ntz")
    extend_history(spark, folder, source, "id", "2024-01-02", updated_at="at")
    before = rows_of(read_history(spark, folder))
    lost = source.withColumns({"valid_from": F.col("at"), "valid_to": F.col("at")})
    lost.write.parquet(f"{folder}/closed/_run=1")
    assert rows_of(read_history(spark, folder)) == before
    changed = source.withColumns({"v": F.lit("b"), "at": F.lit("2024-01-03").cast("timestamp_ntz"), "new": F.lit(1)})
    got = extend_history(spark, folder, changed, "id", "2024-01-04", updated_at="at")
    assert sorted((r.v, r.valid_to is None) for r in got.collect()) == [("a", False), ("b", True)]
