"""Load loop, load state, incremental windows, publishing and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import incremental as I
from strata.operators import watermarks as W
from strata.operators.align import align_by_name, staging_like
from strata.plans import load
from strata.session import staged, work_dir
from strata.specs import FieldMapping, LoadSpec
from strata.streaming import partition_sink, stream_dedup, stream_insert_new, stream_upsert, table_sink

NOW = "2024-02-01 00:00:00"
T0 = dt.datetime(2024, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def spec(**options):
    base = {"incremental_strategy": "timestamp", "incremental_column": "at"}
    return LoadSpec("t", "raw", "t", ("id",), **{**base, **options})


ROW = "id int, v string, at timestamp_ntz"


def table(spark, *rows):
    return spark.createDataFrame([(i, v, day(n) if n is not None else None) for i, v, n in rows], ROW)


def state(spark, *rows):
    """Rows of (table, watermark, status, last_success day)."""
    df = spark.createDataFrame(
        [("raw", "raw", t, w, s, day(d) if d is not None else None, T0) for t, w, s, d in rows],
        "layer string, target_schema string, target_table string, watermark_value string, status string, "
        "last_success_at timestamp_ntz, updated_at timestamp_ntz",
    )
    return align_by_name(df, W.STATE_SCHEMA)


def test_upsert_load(spark):
    result = load.load_batch(table(spark, (1, "a", 1), (2, "b", 1)), table(spark, (2, "B", 5), (2, "x", 3), (3, "c", None)), spec(), state(spark), NOW)
    assert rows_of(result.target, "id", "v") == [(1, "a"), (2, "B"), (3, "c")]
    s = result.state.first()
    assert (s.watermark_value, s.rows_processed, s.status, s.watermark_type) == ("2024-01-06 00:00:00", 3, "success", "timestamp")
    assert s.last_success_at == s.updated_at == dt.datetime(2024, 2, 1)


def test_full_refresh_load(spark):
    s = spec(incremental_strategy="full_refresh", incremental_column=None)
    result = load.load_batch(table(spark, (1, "a", 1)), table(spark, (9, "z", 1)), s, state(spark), NOW)
    assert rows_of(result.target, "id") == [(9,)]
    assert result.state.first().watermark_value == "2024-02-01T00:00:00"


@pytest.mark.parametrize("strategy", ["full_refresh", "timestamp"])
def test_empty_batch_keeps_the_table(spark, strategy):
    known = state(spark, ("t", "2024-01-02", "failed", None))
    result = load.load_batch(table(spark, (1, "a", 1)), staging_like(spark, table(spark, (1, "a", 1)).schema), spec(incremental_strategy=strategy), known, NOW)
    assert result.status == "no_new_data" and rows_of(result.target, "id") == [(1,)]
    s = result.state.first()
    assert (s.status, s.watermark_value, s.last_success_at) == ("no_new_data", "2024-01-02", dt.datetime(2024, 2, 1))


def test_batch_without_watermark_values(spark):
    known = state(spark, ("t", "2024-01-02", "success", 1))
    result = load.load_batch(
        staging_like(spark, table(spark, (1, "a", 1)).schema), table(spark, (1, "a", None)), spec(), known, NOW
    )
    assert result.state.first().watermark_value == "2024-01-02"


@pytest.mark.parametrize("stage", [False, True])
def test_run_load(spark, stage):
    raw = spark.createDataFrame(
        [("1", "n1", "2024-01-05T00:00:00Z"), ("2", "old", "2024-01-02T00:00:00Z"), ("", "no key", "2024-01-09T00:00:00Z"), (None, "x", None)],
        "key string, name string, time string",
    )
    s = spec(field_mappings=(FieldMapping("key", "id"), FieldMapping("name", "v"), FieldMapping("time", "at", "warehouse_ts")))
    target = spark.createDataFrame([], "id string, v string, at string, inserted_at timestamp_ntz, updated_at timestamp_ntz")
    result = load.run_load(raw, target, state(spark, ("t", "2024-01-03 00:00:00", "success", 1)), s, NOW, stage=stage)
    assert rows_of(result.target, "id", "v", "at") == [("1", "n1", "2024-01-05 00:00:00")]
    assert tuple(result.stats.first()) == (4, 2, 2, 1)
    assert result.state.first().watermark_value == "2024-01-05 00:00:00"


def test_records_pass_without_mappings(spark):
    raw = spark.createDataFrame([(None, "n", day(1)), (1, "a", day(1))], ROW)
    result = load.run_load(raw, staging_like(spark, raw.schema), state(spark), spec(), NOW)
    assert result.target.count() == 2 and tuple(result.stats.first()) == (2, 0, 2, 0)


def test_window():
    assert load.extraction_window(spec(), "2024-01-15T10:00:00", NOW) == ("2024-01-15", "2024-02-01")
    assert load.extraction_window(spec(), None, NOW) == ("2023-11-03", "2024-02-01")
    assert load.extraction_window(spec(incremental_strategy="full_refresh"), "2024-01-15", NOW)[0] == "2023-11-03"


def test_execute_load_and_replay(spark):
    folder = work_dir(spark, "exec")
    load.publish(table(spark, (1, "a", 1)), "exec_t", f"{folder}/a")
    load.publish(state(spark), "exec_s", f"{folder}/b")
    windows = []

    def extract(spark, s, start, end):
        windows.append((start, end))
        return table(spark, (1, "A", 20), (2, "b", 10))

    for _ in range(2):
        result = load.execute_load(spark, spec(), extract, "exec_t", "exec_s", folder, NOW)
        assert rows_of(result.target, "id", "v") == [(1, "A"), (2, "b")]
    assert windows == [("2023-11-03", "2024-02-01"), ("2024-01-21", "2024-02-01")]
    # The second run found nothing past the watermark.
    assert result.status == "no_new_data"

    def broken(*_):
        raise RuntimeError("source down " + "x" * 900)

    with pytest.raises(RuntimeError):
        load.execute_load(spark, spec(), broken, "exec_t", "exec_s", folder, NOW)
    s = load.current(spark, "exec_s").first()
    assert s.status == "failed" and len(s.error_message) == 500 and s.watermark_value == "2024-01-21 00:00:00"
    assert load.current(spark, "exec_t").count() == 2


def test_publish_adds_columns(spark):
    folder = work_dir(spark, "pub")
    load.publish(spark.range(3), "pub_t", folder)
    load.publish(spark.table("pub_t").withColumn("extra", F.lit("x")), "pub_t", folder)
    assert rows_of(load.current(spark, "pub_t")) == [(0, "x"), (1, "x"), (2, "x")]


def test_bucketed_target_stays_where_it_is(spark, plan):
    from strata.operators.merge import merge_upsert

    folder = work_dir(spark, "bucket")
    base = spark.range(2000).select("id", F.lit(0).alias("v"))
    load.publish(base, "bucket_t", folder, buckets=4, keys=["id"])
    batch = staged(spark.range(1000, 3000).select("id", F.lit(1).alias("v")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for _ in range(2):
            merged = merge_upsert(load.current(spark, "bucket_t"), batch, "id", co_located=True)
            tree = plan(merged).split("\n\n")[0]
            assert "SortMergeJoin" in tree and tree.count("Exchange") == 1
            load.publish(merged, "bucket_t", folder, buckets=4, keys=["id"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = load.current(spark, "bucket_t").groupBy("v").count()
    assert rows_of(got) == [(0, 1000), (1, 2000)]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("bucket_t")] == ["bucket_t"]


def daily(spark, *rows):
    return spark.createDataFrame([(i, v, day(n).date() if n is not None else None) for i, v, n in rows], "id int, v string, d date")


@pytest.mark.parametrize("literals", [load.PARTITION_LITERALS, 1])
def test_merge_partitions(spark, monkeypatch, literals):
    monkeypatch.setattr(load, "PARTITION_LITERALS", literals)
    path = work_dir(spark, "parts")
    daily(spark, (1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "n", None)).write.partitionBy("d").parquet(path)
    load.merge_partitions(spark, path, daily(spark, (1, "A", 1), (5, "e", 3), (6, "n2", None)), "id,d", "d")
    got = rows_of(spark.read.parquet(path), "id", "v", "d")
    assert got == rows_of(daily(spark, (1, "A", 1), (2, "b", 1), (3, "c", 2), (5, "e", 3), (4, "n", None), (6, "n2", None)))
    with pytest.raises(ValueError, match="part of the key"):
        load.merge_partitions(spark, path, daily(spark, (1, "A", 1)), "id", "d")


def test_untouched_partitions_are_not_rewritten(spark):
    import pathlib

    path = work_dir(spark, "parts")
    daily(spark, (1, "a", 1), (2, "b", 2)).write.partitionBy("d").parquet(path)
    files = lambda d: sorted(p.name for p in pathlib.Path(path, f"d={d}").glob("*.parquet"))
    before = files("2024-01-03")
    load.merge_partitions(spark, path, daily(spark, (1, "A", 1)), "id,d", "d")
    assert files("2024-01-03") == before


def test_state_table(spark):
    known = state(spark, ("a", "1", "success", 1), ("b", "2", "success", 1))
    touch = known.filter("target_table = 'a'").select(*W.STATE_KEY).union(
        spark.createDataFrame([("raw", "raw", "unknown")], "a string, b string, c string")
    )
    started = {r.target_table: r for r in W.watermark_mark_started(known, touch, NOW).collect()}
    assert set(started) == {"a", "b"}
    assert started["a"].last_run_at == dt.datetime(2024, 2, 1) and started["b"].last_run_at is None

    failed = touch.withColumns({"status": F.lit("failed"), "error_message": F.lit("boom")})
    after = {r.target_table: r for r in W.watermark_set_status(known, failed, NOW).collect()}
    assert after["a"].last_success_at == day(1) and after["a"].error_message == "boom"
    assert after["unknown"].status == "failed" and after["unknown"].last_success_at is None
    assert after["unknown"].rows_processed == 0 and after["b"].status == "success"

    values = touch.withColumns({"watermark_value": F.lit("9"), "rows_processed": F.lit(5)})
    updated = {r.target_table: r for r in W.watermark_update(known, values, NOW).collect()}
    assert updated["a"].watermark_value == "9" and updated["a"].rows_processed == 5 and updated["b"].watermark_value == "2"
    assert len(updated) == 3
    assert rows_of(W.watermark_get(known), "target_table", "watermark_value") == [("a", "1"), ("b", "2")]


def test_lookback_on_an_empty_target(spark):
    rows = table(spark, (1, "a", 1), (2, "b", 9))
    empty = staging_like(spark, rows.schema)
    assert I.lookback(rows, "at", I.high_water(empty, "at")).count() == 2
    assert rows_of(I.lookback(rows, "at", I.high_water(rows, "at")), "id") == [(2,)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_lookback_follows_the_wall_clock(spark, kind):
    rows = table(spark, (1, "a", 1), (2, "b", 4), (3, "c", 7)).withColumn("at", F.col("at").cast(kind))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        high = I.high_water(rows, "at")
        assert str(high)[:10] == ("2024-01-07" if kind == "timestamp" else "2024-01-08")
        assert rows_of(I.lookback(rows, "at", high), "id") == [(2,), (3,)]
        assert I.incremental_window(rows, "at", NOW, target_high=high).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_max_watermark_ignores_empty_text(spark):
    df = spark.createDataFrame([("",), ("b",), (None,), ("a",)], "w string")
    assert tuple(I.max_watermark(df, "w").first()) == ("b", "b")
    assert tuple(I.max_watermark(df.filter("w = ''"), "w").first()) == (None, None)
    numbers = spark.createDataFrame([(9,), (10,)], "w int")
    assert tuple(I.max_watermark(numbers, "w").first()) == (10, "10")


def test_filters_reach_the_scan(spark, data, plan):
    events = spark.read.parquet(f"{data}/events.parquet").select("event_id", "ts")
    for df in (
        I.lookback(events, "ts", dt.datetime(2024, 1, 20)),
        I.incremental_window(events, "ts", NOW),
        I.incremental_id(events, "event_id", 5),
    ):
        text = plan(df)
        assert "GreaterThan" in text.split("PushedFilters", 1)[1].split("\n", 1)[0]
        assert "props" not in text and "event_type" not in text


def test_staged_keeps_schema(spark):
    df = spark.createDataFrame([(1, None, [("a", 1)])], "a int, b timestamp_ntz, c array<struct<x: string, y: int>>")
    again = staged(df)
    assert again.schema.simpleString() == df.schema.simpleString() and again.collect() == df.collect()


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def test_stream_upsert_over_several_batches(spark):
    folder = work_dir(spark, "stream")
    source = f"{folder}/in"
    for n in range(3):
        spark.range(n, n + 4).select("id", F.lit(n).alias("v"), F.lit(day(n)).alias("at")).coalesce(1).write.mode("append").json(source)
    load.publish(spark.createDataFrame([(0, -1, day(0)), (50, -1, day(0))], "id bigint, v int, at timestamp_ntz"), "stream_t", f"{folder}/t")
    for _ in range(2):  # a second run finds nothing new
        stream = stream_of(spark, source, "id bigint, v int, at timestamp_ntz")
        stream_upsert(stream, table_sink("stream_t", f"{folder}/t", "id", "at"), f"{folder}/check").awaitTermination()
    got = {r.id: r.v for r in load.current(spark, "stream_t").collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5, 50} and got[50] == -1 and got[0] == 0


def test_stream_into_partitions(spark):
    folder = work_dir(spark, "stream")
    daily(spark, (1, "a", 1)).write.partitionBy("d").parquet(f"{folder}/t")
    daily(spark, (1, "A", 1), (2, "b", 2)).write.json(f"{folder}/in")
    stream = stream_of(spark, f"{folder}/in", "id int, v string, d date")
    stream_upsert(stream, partition_sink(f"{folder}/t", "id,d", "d"), f"{folder}/check").awaitTermination()
    assert rows_of(spark.read.parquet(f"{folder}/t"), "id", "v") == [(1, "A"), (2, "b")]


@pytest.mark.parametrize("spread", [False, True])
def test_stream_dedup(spark, spread):
    folder = work_dir(spark, "dedup")
    for n in range(3):
        spark.range(30).select((F.col("id") % 5).alias("id"), F.lit(day(0)).alias("at"), F.col("id").alias("copy")).coalesce(1).write.mode("append").json(f"{folder}/in")
    out = stream_dedup(
        stream_of(spark, f"{folder}/in", "id bigint, at timestamp_ntz, copy bigint"), "id", "at", spread=F.col("copy") if spread else None
    )
    query = (
        out.writeStream.format("parquet").option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start(f"{folder}/out")
    )
    query.awaitTermination()
    assert rows_of(spark.read.parquet(f"{folder}/out"), "id") == [(i,) for i in range(5)]


def test_publish_keeps_buckets_and_types(spark):
    folder = work_dir(spark, "tables")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    load.publish(rows, "kept_buckets", folder, buckets=2, keys=["id"])
    load.publish(rows.filter("id = 1"), "kept_buckets", folder)
    assert load.bucketing(spark, "kept_buckets") == (2, ["id"])
    assert rows_of(load.current(spark, "kept_buckets")) == [(1, "a")]
    with pytest.raises(ValueError, match="buckets"):
        load.publish(rows, "kept_buckets", folder, buckets=4, keys=["id"])
    with pytest.raises(ValueError, match="other types"):
        load.publish(rows.withColumn("v", F.lit(1)), "kept_buckets", folder)
    assert rows_of(load.current(spark, "kept_buckets")) == [(1, "a")]


def test_pending_partitions_are_replaced_later(spark):
    """A run that died after its new content was complete loses nothing, one that died before changes nothing."""
    path = work_dir(spark, "parts")
    daily(spark, (1, "a", 1), (2, "b", 2)).write.partitionBy("d").parquet(path)
    daily(spark, (1, "A", 1)).write.parquet(f"{path}/{load.PENDING}")
    assert rows_of(spark.read.parquet(path), "id", "v") == [(1, "a"), (2, "b")]
    load.merge_partitions(spark, path, daily(spark, (3, "c", 3)), "id,d", "d")
    assert rows_of(spark.read.parquet(path), "id", "v") == [(1, "A"), (2, "b"), (3, "c")]


def test_a_batch_is_read_once(spark):
    """A source that gives other rows each time stays consistent between touched partitions and merge."""
    path = work_dir(spark, "parts")
    daily(spark, *[(i, "a", i) for i in range(1, 20)]).write.partitionBy("d").parquet(path)
    moving = spark.range(3).select(
        F.lit(0).alias("id"), F.lit("n").alias("v"), F.expr("date_add(DATE'2024-01-01', cast(rand() * 19 as int))").alias("d")
    )
    load.merge_partitions(spark, path, moving, "id,d", "d")
    assert spark.read.parquet(path).filter("id > 0").count() == 19


def test_late_rows_are_inserted(spark):
    """Ids 1, 3, 2 in three micro-batches, 2 being years older: none is lost, and a repeated one is not doubled."""
    folder = work_dir(spark, "late")
    for i, at in ((1, "2024-01-10"), (3, "2024-01-20"), (2, "2020-01-01"), (3, "2024-01-21")):
        spark.createDataFrame([(i, at)], "id int, at string").coalesce(1).write.mode("append").json(f"{folder}/in")
    stream = spark.readStream.schema("id int, at string").option("maxFilesPerTrigger", 1).json(f"{folder}/in")
    stream_insert_new(stream, f"{folder}/out", "id", f"{folder}/check", "at").awaitTermination()
    assert rows_of(spark.read.parquet(f"{folder}/out"), "id") == [(1,), (2,), (3,)]


def test_a_bucketed_table_takes_streams(spark):
    folder = work_dir(spark, "stream")
    load.publish(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), "bucket_stream", folder, buckets=2, keys=["id"])
    for i, v in ((1, "A"), (3, "c")):
        spark.createDataFrame([(i, v)], "id int, v string").write.mode("append").json(f"{folder}/in")
    stream = stream_of(spark, f"{folder}/in", "id int, v string")
    stream_upsert(stream, table_sink("bucket_stream", folder, "id"), f"{folder}/check").awaitTermination()
    assert rows_of(load.current(spark, "bucket_stream")) == [(1, "A"), (2, "b"), (3, "c")]
    assert load.bucketing(spark, "bucket_stream") == (2, ["id"])
