import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from strata.functions import hours_between, json_dump, null_zero_date, surrogate_key, transform, warehouse_ts, yes_flag
from strata.functions.text import clean_string, json_value


def one(spark, column, value=None, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, "1970-01-01 00:00:00"),
        ("", "1970-01-01 00:00:00"),
        ("  \t ", "1970-01-01 00:00:00"),
        ("2024-03-01T10:20:30Z", "2024-03-01 10:20:30"),
        ("2024-03-01t10:20:30z", "2024-03-01t10:20:30 00:00:00"),
        ("2024-03-01T10:20:30.123456Z", "2024-03-01 10:20:30"),
        ("2024-03-01T10:20:30+02:00", "2024-03-01 10:20:30"),
        ("2024-03-01T10:20:30-05:00", "2024-03-01 10:20:30"),
        ("2024-03-01 10:20:30.5", "2024-03-01 10:20:30"),
        (" 2024-03-01 10:20 ", "2024-03-01 10:20"),
        ("2024-03-01", "2024-03-01 00:00:00"),
        ("2024-03-01T", "2024-03-01 "),
        ("2024-03-01 10:20:30 UTC", "2024-03-01 10:20:30 U C"),
        ("Z", " 00:00:00"),
    ],
)
def test_warehouse_ts(spark, text, expected):
    assert one(spark, warehouse_ts("v"), text) == expected


def test_warehouse_ts_of_a_timestamp(spark):
    value = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert one(spark, warehouse_ts("v"), value, "v timestamp_ntz") == "2024-01-02 03:04:05"


@pytest.mark.parametrize(
    "value, schema",
    [
        (5, "v int"),
        (1.5, "v double"),
        (True, "v boolean"),
        ('quote " back \\ line\n', "v string"),
        ([1, 2], "v array<int>"),
        ({"a": None, "b": [1]}, "v struct<a: string, b: array<int>>"),
    ],
)
def test_json_dump_round_trip(spark, value, schema):
    assert json.loads(one(spark, json_dump("v"), value, schema)) == value


def test_json_dump_null(spark):
    assert one(spark, json_dump("v")) is None


def test_surrogate_key(spark):
    row = spark.createDataFrame([(1, None, "")], "a int, b string, c string").select(
        surrogate_key("a").alias("one"), surrogate_key("a", "b", "c").alias("three"), surrogate_key("a", "c", "b").alias("swapped")
    ).first()
    assert row.one == hashlib.md5(b"1").hexdigest()
    assert row.three == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_-").hexdigest()
    assert row.three != row.swapped
    with pytest.raises(ValueError):
        surrogate_key()


def test_null_zero_date(spark):
    rows = spark.createDataFrame([("0000-00-00",), ("0000-00-00 00:00:00",), ("",), ("2024-01-01",), (None,)], "v string")
    got = rows.select(null_zero_date("v").alias("a"), null_zero_date("v", True).alias("b")).collect()
    assert [tuple(r) for r in got] == [(None, None), (None, None), ("", None), ("2024-01-01",) * 2, (None, None)]


def test_small_expressions(spark):
    assert one(spark, clean_string("v"), "  MiXed ") == "mixed"
    assert one(spark, yes_flag("v"), "Y") is True
    assert one(spark, yes_flag("v"), None) is False
    assert one(spark, json_value("v", "a.b", "int"), '{"a": {"b": 3}}') == 3
    assert one(spark, json_value("v", "a.b", "int"), '{"a": {"b": "x"}}') is None
    assert one(spark, json_value("v", "a", "int"), "no json") is None
    hours = hours_between(F.lit("2024-01-02").cast("timestamp_ntz"), F.lit("2024-01-01 12:30:00").cast("timestamp_ntz"))
    assert one(spark, hours) == 11.5


def test_unknown_transform(spark):
    with pytest.raises(ValueError, match="unknown transform"):
        transform("upside_down", F.lit(1))
    assert one(spark, transform(None, F.col("v")), "as is") == "as is"
