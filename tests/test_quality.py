"""Checks, profiles and comparisons."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import audit, profile
from strata.operators import quality as Q
from strata.operators.incremental import detect_strategy
from strata.operators.joins import fk_orphans, left_join_agg, left_lookup
from strata.operators.watermarks import STATE_SCHEMA
from strata.specs import FieldMapping, LoadSpec

T0 = dt.datetime(2024, 1, 1)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def result(df):
    return {r.check_name: (r.passed, r.value) for r in df.collect()}


@pytest.fixture()
def people(spark):
    return spark.createDataFrame(
        [(1, "a", "x@y.z"), (1, "b", "nope"), (2, None, None), (None, "c", "")], "id int, kind string, email string"
    )


def test_column_checks_in_one_scan(people, plan):
    checks = [
        Q.zero_rows(),
        Q.null_pk("id,kind"),
        Q.not_null("email"),
        Q.accepted_values("kind", ["a", "b"]),
        Q.matches("email", r"^[^@]+@[^@]+$"),
        Q.row_count_between(5, 10),
    ]
    got = result(Q.run_checks(people, checks))
    assert got == {
        "zero_rows": (True, "4"),
        "null_pk": (False, "2"),
        "not_null_email": (False, "1"),
        "accepted_values_kind": (False, "1"),
        "regex_email": (False, "2"),
        "row_count_between": (False, "4"),
    }
    assert plan(Q.run_checks(people, checks)).split("\n\n")[0].count("Scan") == 1


def test_empty_table(people):
    empty = people.limit(0)
    assert result(Q.run_checks(empty, [Q.zero_rows(), Q.null_pk("id"), Q.zero_rows("skipped", skip=True)])) == {
        "zero_rows": (False, "0"),
        "null_pk": (True, "0"),
        "skipped": (True, "0"),
    }
    assert result(Q.check_duplicates(empty, "id")) == {"duplicate_pk": (True, "0")}
    assert result(Q.check_relationships(empty, "id", people, "id")) == {"relationships_id": (True, "0")}


def test_keyed_checks(people):
    assert result(Q.check_duplicates(people, "id")) == {"duplicate_pk": (False, "1")}
    assert result(Q.check_duplicates(people, "id,kind")) == {"duplicate_pk": (True, "0")}
    assert result(Q.check_unique(people.union(people.filter("id is null")), "id")) == {"unique_id": (False, "1")}
    parents = people.filter("id = 2")
    assert result(Q.check_relationships(people, "id", parents, "id")) == {"relationships_id": (False, "2")}
    assert rows_of(fk_orphans(people, "id", parents, "id")) == [(1, 2)]


def state(spark, *rows):
    plain = spark.createDataFrame(rows, "target_table string, last_success_at timestamp_ntz")
    return plain.withColumns({"layer": F.lit("raw"), "target_schema": F.lit("raw")})


def test_freshness(spark):
    as_of = T0 + dt.timedelta(hours=48)
    got = result(Q.check_freshness(state(spark, ("on_time", T0), ("late", T0 - dt.timedelta(minutes=6)), ("new", None)), as_of, 48))
    assert got == {"on_time_freshness": (True, "48.0"), "late_freshness": (False, "48.1"), "new_freshness": (True, None)}


def test_source_freshness(spark):
    df = spark.createDataFrame([(T0,), (None,)], "at timestamp_ntz")
    status = lambda hours: Q.source_freshness(df, "at", T0 + dt.timedelta(hours=hours), 24, 48).first().status
    assert [status(h) for h in (24, 24.5, 48, 48.5)] == ["pass", "warn", "warn", "error"]
    assert Q.source_freshness(df.limit(0), "at", T0, 24, 48).first().status == "error"


def test_table_checks_and_assertion(spark, people):
    spec = LoadSpec("p", "raw", "p", ("id",), field_mappings=(FieldMapping("x", "ID"), FieldMapping("y", "gone")))
    checks = Q.table_checks(people, spec, state(spark, ("p", T0)), T0)
    assert {k: v[0] for k, v in result(checks).items()} == {
        "p_zero_rows": True, "p_null_pk": False, "p_duplicate_pk": False, "p_freshness": True, "p_schema": False,
    }
    with pytest.raises(Q.CheckFailed, match="p_null_pk"):
        Q.assert_checks(checks)
    Q.assert_checks(checks.filter("severity = 'WARN'"))


def test_contract(people):
    declared = {"id": "int", "kind": "string", "email": "string"}
    assert Q.assert_contract(people, declared) is people
    for broken in ({**declared, "id": "bigint"}, {"id": "int", "kind": "string"}, {**declared, "x": "int"}, dict(reversed(declared.items()))):
        with pytest.raises(ValueError, match="contract broken"):
            Q.assert_contract(people, broken)


def test_null_column_integrity(spark):
    source = spark.createDataFrame([(1, None, "x"), (2, None, "y")], "id int, unused string, lost string")
    target = source.withColumn("lost", F.lit(None).cast("string")).withColumn("added", F.lit(None).cast("int"))
    assert rows_of(Q.null_column_integrity(target, source)) == [("added", 0, "PASS"), ("lost", 2, "FAIL"), ("unused", 0, "PASS")]


def test_column_stats(people):
    got = rows_of(A.column_stats(people))
    assert got == [("email", "string", 1, 3), ("id", "int", 1, 2), ("kind", "string", 1, 3)]
    assert rows_of(A.column_stats(people, exact=False)) == got


def test_value_counts_order(spark):
    df = spark.createDataFrame([(v,) for v in "bbaac"] + [(None,)], "v string")
    assert [tuple(r) for r in A.value_counts(df, "v", 3).collect()] == [("a", 2), ("b", 2), ("NULL", 1)]


def test_custom_metadata(people):
    got = dict(rows_of(profile.custom_metadata(people, [{"type": "null_count", "column": "email"}, {"type": "value_counts", "column": "id"}])))
    assert got == {"email_null": "2", "email_present": "2", "id_distribution": "1: 2, 2: 1, NULL: 1"}
    with pytest.raises(KeyError):
        profile.custom_metadata(people, [{"type": "horoscope"}])


def test_sample_markdown(spark):
    df = spark.createDataFrame([(2, "y" * 41), (1, None), (3, "z")], "id int, t string")
    text = profile.sample_markdown(df, 2, "id")
    assert text.splitlines() == ["| id | t |", "| --- | --- |", "| 1 |  |", f"| 2 | {'y' * 40}... |"]
    assert profile.sample_markdown(df.limit(0)) == "No data"


def test_run_metadata_without_increment(people):
    row = profile.run_metadata(people, 1, 10, None, None, T0).first()
    assert (row.row_count, row.row_count_delta, row.errors, row.watermark_before, row.watermark_after) == (14, 4, 1, "none", "none")


def test_candidate_keys(spark):
    rows = [(i, i // 4, i % 4, i % 2, None) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, a int, b int, c int, n int")
    assert rows_of(profile.candidate_keys(df)) == [("id", 1, 40)]
    assert rows_of(profile.candidate_keys(df.drop("id"))) == [("a,b", 2, 40)]
    assert rows_of(profile.candidate_keys(df.withColumnRenamed("id", "other").drop("a"))) == [("other", 1, 40)]
    assert rows_of(profile.candidate_keys(df.select("b", "c", "n"))) == []
    assert rows_of(profile.candidate_keys(df.limit(0))) == []
    three = spark.createDataFrame([(i // 4, i // 2 % 2, i % 2) for i in range(40)], "x int, y int, z int")
    assert rows_of(profile.candidate_keys(three)) == [("x,y,z", 3, 40)]


def test_detect_strategy(spark):
    ts = spark.createDataFrame([(1, T0, T0)], "id int, created_at timestamp, MODIFIED_AT timestamp")
    assert tuple(detect_strategy(ts, "id").first())[:2] == ("timestamp", "MODIFIED_AT")
    assert tuple(detect_strategy(ts.drop("MODIFIED_AT"), "id").first())[:4] == ("timestamp", "created_at", "created", "medium")
    text = ts.select("id", F.lit("2024").alias("updated_at"))
    assert tuple(detect_strategy(text, "id").first())[:2] == ("incremental_id", "id")
    assert tuple(detect_strategy(text, "id,updated_at").first()) == ("full_refresh", None, "full", "high", 1)
    assert detect_strategy(spark.range(10_000).withColumnRenamed("id", "k")).first().strategy == "needs_discussion"


def test_audit_except_is_a_multiset_difference(spark):
    a = [(1, "x"), (1, "x"), (1, "x"), (2, None), (3, "z")]
    b = [(1, "x"), (2, None), (2, None), (4, "w")]
    left, right = Counter(a) - Counter(b), Counter(b) - Counter(a)
    expected = [(*k, "a_only", n) for k, n in left.items()] + [(*k, "b_only", n) for k, n in right.items()]
    df = lambda rows: spark.createDataFrame(rows, "i int, s string")
    assert rows_of(audit.audit_except(df(a), df(b))) == sorted(expected, key=repr)
    assert audit.audit_except(df(a), df(a)).count() == 0


def test_audit_compare(spark):
    df = lambda rows: spark.createDataFrame(rows, "k int, v string, m map<string, int>")
    a = df([(1, "a", {"x": 1}), (2, None, None), (3, "c", {}), (4, "d", {}), (5, "e", {}), (5, "e", {}), (6, None, {})])
    b = df([(1, "a", {"x": 2}), (2, "b", None), (3, None, {}), (5, "e", {}), (6, None, {}), (7, "g", {})])
    got = {(c, o): n for c, o, n in rows_of(audit.audit_compare(a, b, "k"))}
    assert {k[1]: n for k, n in got.items() if k[0] == "*"} == {"matched": 4, "a_only": 1, "b_only": 1, "key_not_unique": 1}
    assert {k[1]: n for k, n in got.items() if k[0] == "v"} == {"equal": 1, "both_null": 1, "null_in_a": 1, "null_in_b": 1, "different": 0}
    assert got[("m", "different")] == 1 and got[("m", "both_null")] == 1


@pytest.mark.parametrize("broadcast_bytes, hot_rows", [(None, None), (0, None), (0, 10)])
def test_left_lookup(spark, broadcast_bytes, hot_rows):
    keys = [7] * 40 + [1, 2, None, None, 99]
    facts = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int").repartition(6)
    dim = spark.createDataFrame([(7, "seven", None), (1, "one", 1), (2, None, 2)], "k int, name string, n int")
    out = left_lookup(facts, dim, "k", ["name", "n"], broadcast_bytes=broadcast_bytes, hot_rows=hot_rows)
    names = {7: ("seven", None), 1: ("one", 1), 2: (None, 2)}
    expected = [(k, i, *names.get(k, (None, None))) for i, k in enumerate(keys)]
    assert rows_of(out) == sorted(expected, key=repr)


def test_left_join_agg(spark):
    users = spark.createDataFrame([(1,), (2,)], "id int")
    events = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "x")], "id int, t string")
    out = left_join_agg(users, events, "id", [F.count("t").alias("n"), F.count_distinct("t").alias("d")])
    assert rows_of(out) == [(1, 3, 2), (2, None, None)]


def test_pivot_and_back(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "zz"), (2, "b")], "id int, t string")
    wide = A.pivot_metrics(df, "id", "t", ["a", "b"], "n_")
    assert rows_of(wide) == [(1, 2, 0), (2, 0, 1)]
    assert rows_of(A.unpivot_metrics(wide, "id", ["n_a", "n_b"])) == [(1, "n_a", 2), (1, "n_b", 0), (2, "n_a", 0), (2, "n_b", 1)]
