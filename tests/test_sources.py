import datetime as dt
import gzip
import json
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import sources as S
from strata.session import tune, work_dir
from strata.specs import LoadSpec

SCHEMA = (
    T.StructType()
    .add("id", T.LongType())
    .add("name", T.StringType())
    .add("at", T.TimestampNTZType())
    .add("amount", T.DecimalType(10, 2))
)


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


GOOD = '{"id": 1, "name": "a", "at": "2024-01-01T10:00:00", "amount": 1.10}\n\n   \n{"name": "only later columns", "id": 2, "x": 1}\n'


def test_ndjson(spark, tmp_path):
    rows = S.read_ndjson(spark, write(tmp_path, "a.ndjson", GOOD), SCHEMA).orderBy("id").collect()
    assert [(r.id, r.name, str(r.amount)) for r in rows] == [(1, "a", "1.10"), (2, "only later columns", "None")]
    assert rows[0].at.isoformat() == "2024-01-01T10:00:00"


def test_bad_line_raises(spark, tmp_path):
    path = write(tmp_path, "bad.ndjson", GOOD + '{"id": 3, "na\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        S.read_ndjson(spark, path, SCHEMA).collect()


def test_bad_line_is_dropped_from_gzip(spark, tmp_path):
    path = tmp_path / "export.json.gz"
    path.write_bytes(gzip.compress((GOOD + '{"id": 3, "na\n{"id": 4}\n').encode()))
    rows = S.read_ndjson_tolerant(spark, str(path), SCHEMA, partitions=3)
    assert rows.rdd.getNumPartitions() == 3
    assert rows_of(rows, "id") == [(1,), (2,), (4,)]


def test_csv_columns_by_name(spark, tmp_path):
    text = 'AMOUNT,extra,ID,name,at\n1.50,x,7,"a ""quoted"", comma",2024-01-01 00:00:00\n,,8,,\n'
    rows = S.read_csv(spark, write(tmp_path, "a.csv", text), SCHEMA).orderBy("id").collect()
    assert (rows[0].id, rows[0].name, str(rows[0].amount)) == (7, 'a "quoted", comma', "1.50")
    assert tuple(rows[1]) == (8, None, None, None)


@pytest.mark.parametrize("pretty", [True, False])
def test_wrapped_documents(spark, tmp_path, pretty):
    for n in range(2):
        document = {"metadata": {"source": "s", "total_records": 2}, "records": [{"id": n * 2 + i, "name": "n"} for i in range(2)]}
        write(tmp_path, f"{n}.json", json.dumps(document, indent=2 if pretty else None))
    rows = S.read_wrapped_json(spark, str(tmp_path), SCHEMA, pretty)
    assert rows_of(rows, "id") == [(0,), (1,), (2,), (3,)]


def test_write_ndjson_round_trip(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id bigint, name string").withColumn(
        "at", F.lit("2024-01-01 10:00:00.5").cast("timestamp_ntz")
    ).withColumn("amount", F.lit("3.20").cast("decimal(10,2)"))
    path = S.write_ndjson(df, work_dir(spark, "nd"))
    lines = [json.loads(x) for p in pathlib.Path(path).glob("*.json") for x in p.read_text().splitlines()]
    assert {"id": 1, "name": None, "at": "2024-01-01T10:00:00.500000", "amount": 3.2} in lines
    assert S.read_ndjson(spark, path, SCHEMA).exceptAll(df.select(*SCHEMA.names)).count() == 0


def test_registry(spark, data):
    registry = S.Registry()
    spec = LoadSpec("n", "raw", "n", ("id",))
    registry.declare("files", "nation", f"{data}/nation.parquet")
    registry.declare("custom", "numbers", lambda spark, s: spark.range(3).withColumn("t", F.lit(s.target_table)), spec)
    spark.range(5).createOrReplaceTempView("registry_view")
    registry.declare("views", "five", "registry_view")
    assert registry.tables() == [("custom", "numbers"), ("files", "nation"), ("views", "five")]
    assert registry.source(spark, "files", "nation").count() == 25
    assert rows_of(registry.source(spark, "custom", "numbers"), "t") == [("n",)] * 3
    assert registry.source(spark, "views", "five").count() == 5
    with pytest.raises(KeyError):
        registry.source(spark, "files", "moon")


def test_incremental_scan(spark, data, plan):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    part = S.read_incremental(orders, "o_orderdate", "2000-01-01", columns=["o_orderkey", "o_orderdate"])
    assert part.count() == orders.filter("o_orderdate > timestamp_ntz'2000-01-01'").count()
    text = plan(part)
    assert "GreaterThan(o_orderdate" in text and "o_totalprice" not in text
    assert S.read_incremental(orders, "o_orderdate", "2000-01-01", full_refresh=True).count() == orders.count()
    assert S.read_incremental(orders, "o_orderdate", None).count() == orders.count()


def test_materialize(spark):
    assert S.materialize(spark.range(3), "m_view", "view").count() == 3
    assert S.materialize(spark.range(4), "m_table").count() == 4
    assert S.materialize(spark.range(2), "m_table").count() == 2
    spark.range(1).createOrReplaceTempView("x_airbyte_tmp_1")
    assert "m_table" in S.source_tables(spark) and "x_airbyte_tmp_1" not in S.source_tables(spark)
    with pytest.raises(ValueError):
        S.materialize(spark.range(1), "m", "cube")


def test_layer_schema():
    from strata.sources.tables import layer_schema

    assert layer_schema(" core ", "main", production=True) == "core"
    assert layer_schema("core", "main", production=False) == "core_dev"
    assert layer_schema(None, "main", production=False) == "main"


def test_session(spark):
    assert tune(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    assert work_dir(spark, "a") != work_dir(spark, "a")
    assert work_dir(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_csv_files_with_columns_in_another_order(spark):
    path = work_dir(spark, "csv")
    spark.createDataFrame([(1, "a", "x")], "id int, b string, a string").write.option("header", True).csv(path)
    spark.createDataFrame([("y", 2)], "a string, id int").write.mode("append").option("header", True).csv(path)
    got = S.read_csv(spark, path, T.StructType.fromDDL("id int, a string, b string"))
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "x", "a"), (2, "y", None)]


def test_ndjson_loses_no_record(spark):
    path = work_dir(spark, "lines")
    lines = ['{"id": 1, "at": "2024-01-01T10:00:00Z"}', '{"id": 2, "at": "2024-01-01 10:00:00"}', '{"id": "x", "at": "2024-01-01T12:00:00.5+02:00"}']
    spark.createDataFrame([(x,) for x in [*lines, '{"id": 4', '']], "value string").write.text(path)
    got = S.read_ndjson_tolerant(spark, path, T.StructType.fromDDL("id int, at timestamp_ntz"))
    at = dt.datetime(2024, 1, 1, 10)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, at), (2, at), (None, at.replace(microsecond=500_000))], key=repr)
