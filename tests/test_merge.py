"""Deduplication and upsert against a plain Python model."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import sizing
from strata.operators.dedup import dedup_latest, top_per_key
from strata.operators.merge import full_refresh, merge_upsert, table_backfill

SCHEMA = "a int, b string, ts int, v int, inserted_at int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def make(seed, n, stamp):
    rnd = random.Random(seed)
    pick = lambda *xs: rnd.choice(xs)
    return [
        (pick(1, 2, 3, 4, None), pick("x", "y", None), pick(1, 2, 3, None), pick(10, 20, None), stamp) for _ in range(n)
    ]


def newest(rows):
    """NULL last, greater first, remaining columns as tie-break."""
    order = lambda r: tuple((x is not None, x or 0) for x in (r[2], r[3], r[4]))
    best = {}
    for r in rows:
        if r[:2] not in best or order(r) > order(best[r[:2]]):
            best[r[:2]] = r
    return best


def upserted(target, batch):
    new = newest(batch)
    out, matched = [], set()
    for t in target:
        key = t[:2]
        if None not in key and key in new:
            matched.add(key)
            out.append((*new[key][:4], t[4]))
        else:
            out.append(t)
    return sorted(out + [r for k, r in new.items() if k not in matched], key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_dedup(spark, seed):
    rows = make(seed, 60, 1)
    got = dedup_latest(spark.createDataFrame(rows, SCHEMA).repartition(5), "a,b", "ts")
    assert rows_of(got) == sorted(newest(rows).values(), key=repr)


def test_dedup_on_all_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    assert rows_of(dedup_latest(df, "a,b")) == [(1, 2), (3, 4)]


def test_dedup_orders_nested_columns(spark):
    df = spark.createDataFrame([(1, {"k": "a"}, [1]), (1, {"k": "b"}, [0])], "id int, m map<string, string>, l array<int>")
    assert dedup_latest(df, "id").first().m == {"k": "b"}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("small", [False, True])
def test_upsert(spark, seed, small):
    # A target has one row per complete key; rows without a key are not unique.
    target = list({(r[:2] if None not in r[:2] else i): r for i, r in enumerate(make(seed, 25, 0))}.values())
    batch = make(seed + 100, 40, 1)
    got = merge_upsert(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA), "a,b", "ts", small_batch=small
    )
    assert rows_of(got) == upserted(target, batch)


@pytest.mark.parametrize("small", [False, True])
def test_upsert_twice_is_upsert_once(spark, small):
    target = spark.createDataFrame([(1, "x", 1, 1, 0), (2, "y", 1, 1, 0)], SCHEMA)
    batch = spark.createDataFrame([(2, "y", 2, None, 1), (3, "z", 1, 5, 1)], SCHEMA)
    once = merge_upsert(target, batch, "a,b", "ts", small_batch=small)
    twice = merge_upsert(once, batch, "a,b", "ts", small_batch=small)
    assert rows_of(once) == rows_of(twice) == [(1, "x", 1, 1, 0), (2, "y", 2, None, 0), (3, "z", 1, 5, 1)]


def test_insert_only_can_be_empty(spark):
    target = spark.createDataFrame([(1, "x", 1, 1, 0)], SCHEMA)
    batch = spark.createDataFrame([(1, "x", 2, 2, 9)], SCHEMA)
    assert rows_of(merge_upsert(target, batch, "a,b", insert_only=())) == [(1, "x", 2, 2, 9)]


@pytest.mark.parametrize("small", [False, True])
def test_columns_differ(spark, small):
    target = spark.createDataFrame([(1, "keep", 1)], "id int, target_only string, v int")
    batch = spark.createDataFrame([(1, 5, "new"), (2, 6, "new")], "ID int, V int, batch_only string")
    plain = merge_upsert(target, batch, "id", small_batch=small)
    assert plain.columns == ["id", "target_only", "v"]
    assert rows_of(plain) == [(1, "keep", 5), (2, None, 6)]
    wide = merge_upsert(target, batch, "id", new_columns=True, small_batch=small)
    assert wide.columns == ["id", "target_only", "v", "batch_only"]
    assert rows_of(wide) == [(1, "keep", 5, "new"), (2, None, 6, "new")]


def test_key_only_table_inserts(spark):
    target, batch = (spark.createDataFrame(r, "id int") for r in ([(1,)], [(1,), (2,), (2,)]))
    assert rows_of(merge_upsert(target, batch, "id")) == [(1,), (2,)]


def test_batch_without_key(spark):
    df = spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(ValueError, match="key columns id"):
        merge_upsert(df, df.select("v"), "id")


def test_target_only_null_presence(spark):
    """A matched row is recognised even when every value of it is NULL."""
    target = spark.createDataFrame([(1, 7)], "id int, v int")
    batch = spark.createDataFrame([(1, None)], "id int, v int")
    assert rows_of(merge_upsert(target, batch, "id")) == [(1, None)]


def test_full_refresh(spark):
    target = spark.createDataFrame([(1, "old", 1)], "id int, gone string, v int")
    batch = spark.createDataFrame([(5, 1), (5, 2), (6, None)], "id int, v int")
    assert rows_of(full_refresh(target, batch, "id", "v")) == [(5, None, 2), (6, None, None)]


def test_backfill_keeps_existing_stamp(spark):
    stamp = dt.datetime(2024, 1, 1)
    source = spark.createDataFrame([(1, 2, 3)], "id int, updated_at int, _airbyte_raw_id int")
    out = table_backfill(source, "2024-01-01 00:00:00")
    assert out.columns == ["id", "updated_at", "inserted_at"] and rows_of(out) == [(1, 2, stamp)]
    assert table_backfill(source.select("id"), "2024-01-01").columns == ["id", "inserted_at", "updated_at"]


def test_keys_shrink_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    tree = plan(dedup_latest(df, "k", "id")).split("\n\n")[0]
    # The tree is printed from the result down: the lower limit works on the input of the exchange.
    assert tree.index("WindowGroupLimit") < tree.index("Exchange") < tree.rindex("WindowGroupLimit")
    assert rows_of(top_per_key(df, "k", [F.desc("id")], 2)) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]


def test_small_batch_does_not_shuffle_the_target(spark, plan, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", F.lit(0).alias("v")).write.parquet(path)
    target = spark.read.parquet(path)
    batch = spark.range(10).select("id", F.lit(1).alias("v"))
    shuffled = plan(merge_upsert(target, batch, "id"))
    broadcast = plan(merge_upsert(target, batch, "id", small_batch=True))
    assert "SortMergeJoin" in shuffled
    assert "SortMergeJoin" not in broadcast and "BroadcastHashJoin" in broadcast
    # Scan, then a broadcast join directly on it.
    assert "Cartesian" not in broadcast and "BroadcastNestedLoop" not in broadcast


def test_each_side_is_shuffled_once(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        side = spark.range(1000).select("id", F.lit(0).alias("v"))
        tree = plan(merge_upsert(side, side.withColumn("v", F.lit(1)), "id")).split("\n\n")[0]
        assert "FullOuter" in tree or "SortMergeJoin" in tree
        assert tree.count("Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measuring(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 50 + [(None,)], "t string")
    assert sizing.fits_broadcast(df) and not sizing.fits_broadcast(df, 50_000)
    assert sizing.fits_broadcast(df.limit(0), 0)


def test_hot_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    assert sizing.hot_keys(df, ["k"]) is None
    assert [tuple(r) for r in sizing.hot_keys(df, ["k"], min_rows=1000).collect()] == [(-1, 1000)]
