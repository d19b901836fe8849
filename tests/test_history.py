"""Slowly changing history against a plain Python model and its invariants."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import history as H

DAY = dt.datetime(2024, 1, 1)


def at(n):
    return None if n is None else DAY + dt.timedelta(hours=n)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


SOURCE = "id int, v string, updated_at timestamp_ntz"


def source(spark, *rows):
    return spark.createDataFrame([(i, v, at(t)) for i, v, t in rows], SOURCE)


def test_timestamp_snapshots(spark):
    first = H.snapshot_timestamp(None, source(spark, (1, "a", 1), (2, "b", 1), (3, "c", 1)), "id", "updated_at", at(2))
    second = H.snapshot_timestamp(
        first, source(spark, (1, "A", 5), (2, "changed without time", 1), (4, "d", 4)), "id", "updated_at", at(6), hard_deletes=True
    )
    assert rows_of(second, "id", "v", "valid_from", "valid_to") == sorted(
        [
            (1, "a", at(1), at(5)),
            (1, "A", at(5), None),
            (2, "b", at(1), None),
            (3, "c", at(1), at(6)),
            (4, "d", at(4), None),
        ],
        key=repr,
    )
    # 3 comes back: a new version opens, the closed one stays.
    third = H.snapshot_timestamp(second, source(spark, (1, "A", 5), (2, "b", 1), (3, "c2", 8), (4, "d", 4)), "id", "updated_at", at(9), True)
    assert [r for r in rows_of(third, "id", "v", "valid_from", "valid_to") if r[0] == 3] == [
        (3, "c", at(1), at(6)),
        (3, "c2", at(8), None),
    ]


def test_same_source_changes_nothing(spark):
    src = source(spark, (1, "a", 1), (2, None, 1))
    once = H.snapshot_check(None, src, "id", None, at(2))
    assert rows_of(H.snapshot_check(once, src, "id", None, at(3), hard_deletes=True)) == rows_of(once)
    once = H.snapshot_timestamp(None, src, "id", "updated_at", at(2))
    assert rows_of(H.snapshot_timestamp(once, src, "id", "updated_at", at(3), True)) == rows_of(once)


def test_check_snapshot_treats_null_as_a_value(spark):
    first = H.snapshot_check(None, source(spark, (1, None, 1), (2, "b", 1), (3, None, 1)), "id", ["v"], at(2))
    second = H.snapshot_check(first, source(spark, (1, "a", 1), (2, None, 1), (3, None, 9)), "id", ["v"], at(3))
    assert rows_of(second, "id", "v", "valid_from", "valid_to") == sorted(
        [(1, None, at(2), at(3)), (1, "a", at(3), None), (2, "b", at(2), at(3)), (2, None, at(3), None), (3, None, at(2), None)],
        key=repr,
    )


def test_source_duplicates_and_new_columns(spark):
    first = H.snapshot_timestamp(None, source(spark, (1, "a", 1), (1, "newer", 2)), "id", "updated_at", at(3))
    assert rows_of(first, "v") == [("newer",)]
    wider = source(spark, (1, "again", 4)).withColumn("more", F.lit(7))
    second = H.snapshot_timestamp(first, wider, "id", "updated_at", at(5))
    assert rows_of(second, "v", "more") == [("again", 7), ("newer", None)]


def test_rows_without_a_key(spark):
    first = H.snapshot_check(None, source(spark, (None, "n", 1), (1, "a", 1)), "id", ["v"], at(2))
    second = H.snapshot_check(first, source(spark, (None, "n", 1), (1, "a", 1)), "id", ["v"], at(3), hard_deletes=True)
    assert rows_of(second, "id", "valid_from", "valid_to") == sorted(
        [(1, at(2), None), (None, at(2), None), (None, at(3), None)], key=repr
    )


def change_log(seed, n=400):
    """A third of the changes belong to one key, another part to no key."""
    rnd = random.Random(seed)
    return [
        (rnd.choice([7, 7, 7, None, 1, 2, 3, 4, 5]), at(rnd.randrange(300)), i) for i in range(n)
    ]


LOG = "k int, t timestamp_ntz, v int"


def model_history(log):
    last = {}
    for k, t, v in log:
        last[(k, t)] = max(v, last.get((k, t), -1))
    out = []
    for k in {k for k, _ in last}:
        times = sorted(t for kk, t in last if kk == k)
        for t, nxt in zip(times, [*times[1:], None]):
            out.append((k, t, last[(k, t)], t, nxt))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_bulk_history_sliced_and_whole(spark, seed):
    log = change_log(seed)
    df = spark.createDataFrame(log, LOG).repartition(4)
    slices = H.time_slices([(df, "t")], ["k"], hot_rows=30, slice_rows=10)
    cut = {r.k: r._last_slice for r in slices.edges.collect()}
    assert cut[7] > 8 and cut[None] > 2
    expected = model_history(log)
    assert rows_of(H.bulk_history(df, "k", "t", ["v"], slices=None)) == expected
    assert rows_of(H.bulk_history(df, "k", "t", ["v"])) == expected
    assert rows_of(H.bulk_history(df, "k", "t", ["v"], slices=slices)) == expected


def test_slices_are_balanced(spark):
    """Most of a hot key's rows lie in a short burst; slices still get similar shares."""
    times = [at(0)] + [at(900) + dt.timedelta(seconds=s) for s in range(2000)] + [at(1000)]
    df = spark.createDataFrame([(1, t) for t in times] + [(2, at(5))], "k int, t timestamp_ntz")
    slices = H.time_slices([(df, "t")], "k", hot_rows=100, slice_rows=50)
    sizes = H._with_slice(H._with_edges(df, slices), F.col("t"), slices, "_slice").groupBy("k", "_slice").count()
    counts = [r["count"] for r in sizes.collect()]
    assert sum(counts) == len(times) + 1 and max(counts) <= 100 and len(counts) > 20
    assert H.time_slices([(df, "t")], "k") is None


def test_history_invariants(spark):
    df = spark.createDataFrame(change_log(9), LOG)
    hist = H.bulk_history(df, "k", "t", ["v"])
    per_key = hist.groupBy("k").agg(
        F.count_if(F.col("valid_to").isNull()).alias("open"), F.count_if(F.col("valid_to") <= F.col("valid_from")).alias("bad")
    )
    assert {(r.open, r.bad) for r in per_key.collect()} == {(1, 0)}


@pytest.mark.parametrize("seed", range(3))
def test_asof_join_sliced_and_whole(spark, seed):
    rnd = random.Random(seed)
    hist_rows = [r for r in model_history(change_log(seed, 150)) if rnd.random() < 0.8 and r[0] is not None]
    # A third of the facts hit the hot key; some have no key, some no time, some precede all versions.
    facts = [
        (rnd.choice([7, 7, 1, 2, 99, None]), rnd.choice([at(rnd.randrange(-20, 320)), at(rnd.randrange(300)), None]), i)
        for i in range(300)
    ]
    expected = []
    for k, t, i in facts:
        hit = [
            v for hk, _, v, start, stop in hist_rows
            if k is not None and t is not None and hk == k and start <= t and (stop is None or t < stop)
        ]
        assert len(hit) <= 1
        expected.append((k, t, i, hit[0] if hit else None))
    f = spark.createDataFrame(facts, "k int, t timestamp_ntz, i int").repartition(4)
    h = spark.createDataFrame(hist_rows, "k int, t timestamp_ntz, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    slices = H.time_slices([(f, "t"), (h, "valid_from")], ["k"], hot_rows=30, slice_rows=8)
    assert {r.k: r._last_slice for r in slices.edges.collect()}[7] > 8
    for s in (None, slices):
        assert rows_of(H.asof_join(f, h, "k", "t", ["v"], slices=s)) == sorted(expected, key=repr)


def test_asof_join_keeps_null_attributes(spark):
    h = spark.createDataFrame([(1, "x", at(0), at(5)), (1, None, at(5), None)], "k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    f = spark.createDataFrame([(1, at(2)), (1, at(5)), (1, at(9))], "k int, t timestamp_ntz")
    assert rows_of(H.asof_join(f, h, "k", "t", ["v"])) == sorted([(1, at(2), "x"), (1, at(5), None), (1, at(9), None)], key=repr)


def test_dim_scd1(spark):
    out = H.dim_scd1(source(spark, (1, "a", 1), (1, "b", 2), (2, "c", None)), "id", ["id", "v"], "updated_at")
    assert rows_of(out) == [(1, "b"), (2, "c")]
