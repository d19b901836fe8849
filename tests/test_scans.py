"""What is read: by streams that insert, by profiles and checks, by ranges of a database column."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.operators import profile, quality
from strata.operators.align import staging_like
from strata.operators.watermarks import STATE_SCHEMA
from strata.plans import load
from strata.sources import tables
from strata.specs import LoadSpec
from strata.streaming import file_sink, keyset, loads, stream_insert_new, stream_upsert, table_sink


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_twenty_batches_read_what_they_might_repeat(spark, tmp_path, monkeypatch):
    """New keys cost no look at the rows before; a repeated one costs its bucket."""
    read = []
    inner = keyset.written_rows

    def counted(spark, path, keys, number, buckets):
        rows = inner(spark, path, keys, number, buckets)
        read.append((number, len(buckets), rows.count()))
        return rows

    monkeypatch.setattr(loads, "written_rows", counted)
    rng, seen = random.Random(20), set()
    out, check = f"{tmp_path}/out", f"{tmp_path}/check"
    for k in range(20):
        ids = [1000 * k + i for i in range(50)] + ([rng.choice(sorted(seen))] if k % 5 == 4 else [])
        seen |= set(ids)
        spark.createDataFrame([(i, f"t{k}") for i in ids + ids[:3]], "id long, at string").write.mode("append").json(f"{tmp_path}/in")
        stream = spark.readStream.schema("id long, at string").json(f"{tmp_path}/in")
        stream_insert_new(stream, out, "id", check, "at", buckets=16, bits=1 << 22).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == len(seen) == got.select("id").distinct().count()
    # Four batches have one repeated key; a hash of a new key meets a set bit once in a thousand times.
    assert {n for n, _, _ in read} >= {4, 9, 14, 19} and len(read) <= 8
    assert all(buckets <= 3 and rows <= 3 * 1000 / 16 * 2.5 for _, buckets, rows in read)
    assert len(list((tmp_path / "out" / "_bits").iterdir())) == 2


def test_a_replayed_batch_gives_the_same_rows(spark, tmp_path):
    """Bits of an attempt that died make its keys doubtful, not lost."""
    out = f"{tmp_path}/out"
    bits = keyset.KeyBits(spark, out, ["id"], 1 << 20)
    bits.add(spark.range(5), 0)
    assert {r.id: r._maybe for r in bits.maybe_written(spark.range(8)).collect()} == {i: i < 5 for i in range(8)}
    spark.range(5).write.json(f"{tmp_path}/in")
    spark.range(1).selectExpr("CAST(NULL AS BIGINT) AS id", "1 AS x").write.mode("append").json(f"{tmp_path}/in")
    spark.range(0).selectExpr("id", "1 AS _bucket").write.partitionBy("_bucket").parquet(f"{out}/_batch=-1")
    spark.createDataFrame([(77, 3)], "id long, _bucket int").write.mode("overwrite").partitionBy("_bucket").parquet(f"{out}/_batch=-1")
    stream = spark.readStream.schema("id long").json(f"{tmp_path}/in")
    stream_insert_new(stream, out, "id", f"{tmp_path}/check", bits=1 << 20).awaitTermination()
    assert rows_of(spark.read.parquet(out).select("id")) == [(0,), (1,), (2,), (3,), (4,), (77,), (None,)]


def test_file_and_table_sinks(spark, tmp_path):
    path, name = f"{tmp_path}/files", f"sink_{tmp_path.name}".replace("-", "_")
    spark.range(100).selectExpr("id", "'old' AS v").repartitionByRange(10, "id").write.parquet(path)
    load.publish(spark.range(3).selectExpr("id", "'old' AS v"), name, f"{tmp_path}/t")
    for k in range(4):
        spark.createDataFrame([(k, f"n{k}")], "id long, v string").write.mode("append").json(f"{tmp_path}/in")
        for sink, check in ((file_sink(path, "id"), "c1"), (table_sink(name, f"{tmp_path}/t", "id", keep=1), "c2")):
            stream = spark.readStream.schema("id long, v string").json(f"{tmp_path}/in")
            stream_upsert(stream, sink, f"{tmp_path}/{check}").awaitTermination()
    assert spark.read.parquet(path).filter("v <> 'old'").count() == 4 and spark.read.parquet(path).count() == 100
    assert rows_of(load.current(spark, name)) == [(k, f"n{k}") for k in range(4)]
    assert len([p for p in (tmp_path / "t").iterdir() if p.is_dir()]) == 2
    spark.sql(f"DROP TABLE {name}")


def test_ten_entries_take_one_scan(spark, tmp_path, plan):
    spark.range(300).selectExpr("id", "IF(id % 3 = 0, NULL, CAST(id % 7 AS string)) AS a", "IF(id % 5 = 0, '', 'x') AS b", "id % 40 AS c").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    entries = [{"type": t, "column": c} for t in ("null_count", "value_counts") for c in ("id", "a", "b", "c")]
    entries += [{"type": "row_count_by_event_type", "column": "a"}, {"type": "null_count", "column": "a"}]
    out = profile.custom_metadata(df, entries)
    text = plan(out)
    assert len(entries) == 10 and len(re.findall(r"\(\d+\) Scan parquet", text)) == 1
    got = rows_of(out)
    assert ("a_null", "100") in got and ("b_null", "60") in got and ("b_present", "240") in got and len(got) == 15
    counts = {r.a: r["count"] for r in df.groupBy("a").count().collect()}
    want = ", ".join(f"{v or 'NULL'}: {n}" for n, v in sorted(((n, v) for v, n in counts.items()), key=lambda x: (-x[0], x[1] or "NULL")))
    assert dict(got)["a_distribution"] == dict(got)["row_count_by_event_type"] == want
    assert dict(got)["id_distribution"].count(": ") == 20
    empty = dict(rows_of(profile.custom_metadata(df.limit(0), entries[:6])))
    assert empty["a_null"] == "0" and empty["a_distribution"] == ""


def test_standing_checks_take_one_scan(spark, tmp_path, plan):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "d"), (None, None)]
    spark.createDataFrame(rows, "id long, v string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = quality.table_checks(df, LoadSpec("t", "raw", "t", ("id",)), staging_like(spark, STATE_SCHEMA), "2024-01-31")
    assert len(re.findall(r"\(\d+\) Scan parquet", plan(out))) == 1
    got = {r.check_name: (r.passed, r.value) for r in out.collect()}
    assert got["t_zero_rows"] == (True, "6") and got["t_null_pk"] == (False, "3") and got["t_duplicate_pk"] == (False, "2")
    none = {r.check_name: (r.passed, r.value) for r in quality.table_checks(df.limit(0), LoadSpec("t", "raw", "t", ("id",)), staging_like(spark, STATE_SCHEMA), "2024-01-31").collect()}
    assert none["t_zero_rows"] == (False, "0") and none["t_null_pk"] == (True, "0") and none["t_duplicate_pk"] == (True, "0")


@pytest.mark.parametrize("skew", [False, True])
def test_ranges_of_a_database_column(skew):
    """The queries and conditions on a table of this process; nearly all ids lie in one corner."""
    con = duckdb.connect()
    extra = "UNION ALL SELECT 1000000 + range * 100000 FROM range(20)" if skew else ""
    con.execute(f"CREATE TABLE t AS SELECT * FROM (SELECT range AS id FROM range(5000) {extra} UNION ALL SELECT NULL)")
    condition = tables.newer_condition("id", 9)
    low, high = con.execute(tables.bounds_query("t", "id", condition)).fetchone()
    width = (high - low) / tables.STEPS
    steps = dict(con.execute(tables.steps_query("t", "id", condition, low, width)).fetchall())
    parts = tables.range_predicates("id", {int(k): n for k, n in steps.items()}, low, width, 8)
    held = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in parts]
    assert sum(held) == con.execute("SELECT count(*) FROM t").fetchone()[0]
    # Steps are the finest cut: in the skewed table the corner takes two or three of them.
    assert len(parts) <= 8 and (max(held) < 800 if not skew else max(held) <= max(steps.values()) + 700)
    assert tables.range_predicates("id", {}, 0, 1, 4) == ["1 = 1"] and tables.newer_condition("a", "o'k") == "a > 'o''k'"
