import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import align, mapping
from strata.specs import FieldMapping, LoadSpec, key_list, read_specs, spec_from_config

RECORD = "id string, host struct<email: string, geo: struct<lat: double>>, tags map<string, string>, extra variant"


@pytest.fixture()
def records(spark):
    rows = [
        ("1", ("a@x", (1.5,)), {"k": "v"}, '{"deep": {"n": 7}}'),
        ("2", (None, None), {}, "3"),
        (None, None, None, None),
        ("", ("b@x", (2.5,)), {"k": None}, "{}"),
    ]
    plain = RECORD.replace("variant", "string")
    return spark.createDataFrame(rows, plain).withColumn("extra", F.parse_json("extra"))


def values(df):
    return [tuple(r) for r in df.collect()]


def test_nested_paths(records):
    s = records.schema
    got = values(
        records.select(
            mapping.nested(s, "host.email"),
            mapping.nested(s, "host.geo.lat"),
            mapping.nested(s, "host.email.more"),
            mapping.nested(s, "nowhere.at.all"),
            mapping.nested(s, "tags.k"),
            F.to_json(mapping.nested(s, "extra.deep.n")),
        )
    )
    assert got[0] == ("a@x", 1.5, None, None, "v", "7")
    assert got[1] == (None, None, None, None, None, None)
    assert got[2] == (None,) * 6


def test_paths_are_case_sensitive(records):
    assert values(records.limit(1).select(mapping.nested(records.schema, "HOST.email"))) == [(None,)]


def test_map_fields(records):
    out = mapping.map_fields(
        records,
        [FieldMapping("id", "key"), FieldMapping("host", "host_json", "json_dump"), FieldMapping("id", "text", "to_str")],
        "2024-01-01 00:00:00",
        ("inserted_at",),
    )
    assert out.columns == ["key", "host_json", "text", "inserted_at"]
    first = out.first()
    assert json.loads(first.host_json) == {"email": "a@x", "geo": {"lat": 1.5}}
    assert first.inserted_at == dt.datetime(2024, 1, 1)
    with pytest.raises(ValueError):
        mapping.map_fields(records, [FieldMapping("id", "x", "nope")])


def test_missing_pk(spark, records):
    assert [r.id for r in mapping.filter_missing_pk(records, "id").collect()] == ["1", "2"]
    rows = spark.createDataFrame([(0, "a"), (1, ""), (2, None), (None, "b")], "n int, t string")
    assert values(mapping.filter_missing_pk(rows, "n, t")) == [(0, "a")]


def test_watermark_filter_is_typed(spark):
    rows = spark.createDataFrame([(9,), (10,), (None,)], "n int")
    assert values(mapping.filter_watermark(rows, "n", "9")) == [(10,), (None,)]
    assert values(mapping.filter_watermark(rows, "n", "9", keep_null=False)) == [(10,)]
    assert mapping.filter_watermark(rows, "n", None).count() == 3


def test_date_range(spark):
    state = spark.createDataFrame([("2024-01-15T10:00:00",), (None,), ("no date here",)], "watermark_value string")
    got = [(r.from_date, r.to_date) for r in mapping.date_range(state, "2024-01-31").collect()]
    today = dt.date(2024, 1, 31)
    old = today - dt.timedelta(days=90)
    assert got == [(dt.date(2024, 1, 15), today), (old, today), (old, today)]


def test_limit_recent_off(spark):
    rows = spark.createDataFrame([(dt.date(2000, 1, 1),)], "d date")
    assert mapping.limit_recent(rows, "d", "2024-01-01", enabled=False).count() == 1
    assert mapping.limit_recent(rows, "d", "2024-01-01").count() == 0


def test_rename_conflict(spark):
    df = spark.createDataFrame([(1, 2)], "acct_id int, sf_account_id int")
    with pytest.raises(ValueError, match="account_id"):
        mapping.rename_glossary(df)
    df = spark.createDataFrame([(1, 2)], "acct_id int, account_id int")
    with pytest.raises(ValueError, match="account_id"):
        mapping.rename_glossary(df)


def test_map_types(spark):
    df = spark.createDataFrame([("5", "true", "x", '{"a":1}', "13/45"), ("bad", "2", None, "bad", "2024-02-03")], "i string, b string, v string, j string, d string")
    out = mapping.map_types(df, {"i": "int", "b": "boolean", "v": "varchar(20)", "j": "jsonb", "d": "date"})
    assert [out.schema[c].dataType.simpleString() for c in out.columns] == ["bigint", "bigint", "string", "variant", "date"]
    rows = out.withColumn("j", F.to_json("j")).collect()
    assert tuple(rows[0])[:4] == (5, 1, "x", '{"a":1}')
    assert tuple(rows[1]) == (None, 2, None, None, dt.date(2024, 2, 3))
    with pytest.raises(ValueError):
        mapping.map_types(df, {"i": "geometry"})


def test_order_columns(spark):
    names = ["updated_at", "total_x", "name", "a_id", "o_sk", "inserted_at", "me_sk", "created_at", "days_count"]
    df = spark.createDataFrame([tuple(range(len(names)))], names)
    assert mapping.order_columns(df, "me_sk").columns == [
        "me_sk", "o_sk", "a_id", "name", "total_x", "days_count", "created_at", "updated_at", "inserted_at",
    ]


def test_column_intersect(spark):
    df = spark.createDataFrame([(1, 2, 3)], "ID int, name int, other int")
    out = align.column_intersect(df, T.StructType.fromDDL("NAME string, gone int, id bigint"))
    assert out.columns == ["NAME", "id"] and values(out) == [("2", 1)]
    with pytest.raises(ValueError, match="no common columns"):
        align.column_intersect(df, T.StructType.fromDDL("x int"))


def test_nested_values_into_text_columns(spark):
    df = spark.createDataFrame([((1, [2]),)], "s struct<a: int, b: array<int>>")
    out = align.align_by_name(df, T.StructType.fromDDL("s string, more int"))
    assert values(out) == [('{"a":1,"b":[2]}', None)]
    assert all(f.nullable for f in align.staging_like(spark, df.schema).schema)


def test_specs(tmp_path):
    assert key_list(" a , b ") == ["a", "b"]
    with pytest.raises(ValueError):
        key_list(" , ")
    config = tmp_path / "config.yaml"
    config.write_text(
        "source: shop\ndefault_tags: {schedule_tier: weekly}\nassets:\n"
        "  - {name: o, target_schema: raw, target_table: orders, primary_key: 'id,day', incremental_strategy: timestamp,\n"
        "     incremental_column: day, field_mappings: [{source: a.b, column: id, transform: to_str}], auto_timestamps: false}\n"
        "  - {name: p, target_schema: raw, target_table: parts, primary_key: [id], tags: {schedule_tier: hourly}}\n"
    )
    orders, parts = read_specs(str(config))
    assert orders.primary_key == ("id", "day") and orders.max_age_hours == 192 and orders.auto_timestamps == ()
    assert orders.field_mappings == (FieldMapping("a.b", "id", "to_str"),) and orders.expected_columns == ["id"]
    assert parts.incremental_strategy == "full_refresh" and parts.max_age_hours == 6
    assert parts.auto_timestamps == ("inserted_at", "updated_at") and parts.full_name == "raw.parts"
    assert LoadSpec("x", "s", "t", "a,b").primary_key == ("a", "b")
    assert spec_from_config({"name": "n", "target_schema": "s", "target_table": "t", "primary_key": "k", "freshness_max_hours": 3}).max_age_hours == 3
