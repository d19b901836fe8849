"""File and table sources and sinks. Files are written from the given tables into the shared folder first."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import sources as S
from strata.operators.align import align_by_name
from strata.operators.watermarks import STATE_SCHEMA
from strata.plans import load
from strata.queries.base import AS_OF, ORACLES, query, table
from strata.queries.inputs import STAGING, TARGET, customer_v1, customer_v2, events_staging, events_target
from strata.queries.loads import _run_inputs
from strata.session import work_dir

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
_EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value FROM events"


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")


# A wrong value in every 30th record, NULL after reading.
_TYPED_SQL = "SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 30 <> 7 THEN value END AS value FROM events"


def _written(ts):
    """A time as text: ISO with Z, with an offset, with a blank and no fraction lost, or plain ISO."""
    micros = "HH:mm:ss.SSSSSS"
    shifted = F.date_format(F.col(ts) + F.expr("INTERVAL 2 HOURS"), f"yyyy-MM-dd'T'{micros}'+02:00'")
    plain = F.date_format(ts, f"yyyy-MM-dd'T'{micros}")
    kind = F.col("event_id") % 4
    return F.when(kind == 0, F.concat(plain, F.lit("Z"))).when(kind == 1, shifted).when(kind == 2, F.date_format(ts, f"yyyy-MM-dd {micros}")).otherwise(plain)


def _wrong_value():
    return F.when(F.col("event_id") % 30 == 7, "not a number").otherwise(F.col("value").cast("string"))


@query("scan_ndjson", _TYPED_SQL)
def scan_ndjson(spark, d):
    """Times in four written forms, and a value of the wrong type, which is NULL while its record stays."""
    rows = _events(spark, d).withColumns({"ts": _written("ts"), "value": _wrong_value(), "not_in_target": F.lit(1)})
    path = S.write_ndjson(rows, work_dir(spark, "ndjson"))
    return S.read_ndjson(spark, path, T.StructType.fromDDL(_EVENTS))


@query("scan_ndjson_gz_tolerant", f"{_TYPED_SQL} WHERE event_id % 50 <> 0")
def scan_ndjson_gz_tolerant(spark, d):
    line = F.to_json(F.struct("*"))
    broken = F.when(F.col("event_id") % 50 == 0, F.substring(line, 1, 20)).otherwise(line)
    path = work_dir(spark, "export")
    rows = _events(spark, d).withColumns({"ts": _written("ts"), "value": _wrong_value()})
    rows.select(broken.alias("value")).write.option("compression", "gzip").text(path)
    return S.read_ndjson_tolerant(spark, path, T.StructType.fromDDL(_EVENTS))


@query("scan_csv", _EVENTS_SQL)
def scan_csv(spark, d):
    path = work_dir(spark, "csv")
    text = _events(spark, d).select(
        "event_type", "value", F.col("ts").cast("string").alias("TS"), F.lit('a "quoted", text').alias("extra"), "event_id", "user_id"
    )
    # Two sorts of files with the same columns in different order.
    text.filter("event_id % 3 = 0").write.options(header=True, escape='"').csv(path)
    other = text.filter("event_id % 3 <> 0").select(*reversed(text.columns))
    other.write.mode("append").options(header=True, escape='"').csv(path)
    return S.read_csv(spark, path, T.StructType.fromDDL(_EVENTS))


@query("scan_wrapped_json", _EVENTS_SQL)
def scan_wrapped_json(spark, d):
    # Event ids are unique, so a document holds at most 500 records.
    record = F.struct("event_id", "ts", "user_id", "event_type", "value")
    documents = (
        _events(spark, d)
        .groupBy(F.floor(F.col("event_id") / 500).alias("page"))
        .agg(F.collect_list(record).alias("records"))
        .select(
            F.struct(F.lit(AS_OF).alias("extracted_at"), F.size("records").alias("total_records")).alias("metadata"),
            "records",
        )
    )
    path = S.write_ndjson(documents, work_dir(spark, "wrapped"))
    return S.read_wrapped_json(spark, path, T.StructType.fromDDL(_EVENTS), pretty=False)


@query("scan_incremental", "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-01 00:00:00'")
def scan_incremental(spark, d):
    columns = ["o_orderkey", "o_orderdate", "o_orderstatus"]
    return S.read_incremental(table(spark, d, "orders"), "o_orderdate", "2000-06-01 00:00:00", columns=columns)


@query(
    "write_ndjson",
    """SELECT '{"event_id":' || event_id || ',"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","kind":'
      || coalesce('"' || NULLIF(event_type, 'view') || '"', 'null') || '}' AS line FROM events""",
)
def write_ndjson(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", F.col("ts").alias("at"), F.nullif("event_type", F.lit("view")).alias("kind")
    )
    path = S.write_ndjson(rows, work_dir(spark, "ndjson"))
    return spark.read.text(path).withColumnRenamed("value", "line")


_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels",
    "embeddings", "benchmark", "conversations",
)


@query(
    "source_registry",
    " UNION ALL ".join(f"SELECT 'warehouse' AS source, '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES),
)
def source_registry(spark, d):
    registry = S.Registry()
    for name in _TABLES:
        registry.declare("warehouse", name, f"{d}/{name}.parquet")
    out = None
    for source, name in registry.tables():
        part = registry.source(spark, source, name).agg(
            F.lit(source).alias("source"), F.lit(name).alias("table_name"), F.count("*").alias("n_rows")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("materialize_view", "SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id")
def materialize_view(spark, d):
    per_user = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n_events"))
    return S.materialize(per_user, "strata_events_per_user", "view")


@query(
    "merge_partitions",
    f"""WITH {TARGET}, {STAGING}, t AS (SELECT event_id, ts, value, CAST(ts AS DATE) AS day FROM tgt),
    s AS (SELECT * FROM (SELECT event_id, ts, value, CAST(ts AS DATE) AS day,
        row_number() OVER (PARTITION BY event_id, CAST(ts AS DATE) ORDER BY ts DESC) AS rn
      FROM (SELECT * REPLACE (CASE WHEN CAST(ts AS DATE) < DATE '2024-01-20' THEN ts + INTERVAL 10 YEAR ELSE ts END AS ts) FROM stg)) WHERE rn = 1)
    SELECT coalesce(t.event_id, s.event_id) AS event_id, coalesce(s.ts, t.ts) AS ts,
      CASE WHEN s.event_id IS NOT NULL THEN s.value ELSE t.value END AS value, coalesce(t.day, s.day) AS day
    FROM t FULL OUTER JOIN s ON t.event_id = s.event_id AND t.day = s.day""",
)
def merge_partitions(spark, d):
    def daily(df):
        return df.select("event_id", "ts", "value", F.col("ts").cast("date").alias("day"))

    path = work_dir(spark, "daily")
    daily(events_target(spark, d)).write.partitionBy("day").parquet(path)
    # Rows of earlier days move ten years on, so that those days' partitions are not touched.
    early = F.col("ts").cast("date") < F.lit("2024-01-20").cast("date")
    moved = events_staging(spark, d).withColumn("ts", F.when(early, F.col("ts") + F.expr("INTERVAL 10 YEARS")).otherwise(F.col("ts")))
    batch = daily(moved)
    load.merge_partitions(spark, path, batch, ["event_id", "day"], "day", "ts")
    return spark.read.parquet(path)


@query("merge_upsert_by_file", ORACLES["merge_upsert"])
def merge_upsert_by_file(spark, d):
    path = work_dir(spark, "by-file")
    events_target(spark, d).repartitionByRange(16, "event_id").write.parquet(path)
    load.merge_files(spark, path, events_staging(spark, d), "event_id", "ts")
    return spark.read.parquet(path)


@query("execute_load", ORACLES["run_load"])
def execute_load(spark, d):
    return _executed(spark, d).target


def _executed(spark, d):
    raw, target, known, spec = _run_inputs(spark, d)
    folder = work_dir(spark, "tables")
    mark = folder.rsplit("-", 1)[1]
    target_table, state_table = f"strata_events_{mark}", f"strata_state_{mark}"
    load.publish(target, target_table, f"{folder}/{target_table}")
    load.publish(align_by_name(known, STATE_SCHEMA), state_table, f"{folder}/{state_table}")
    return load.execute_load(spark, spec, lambda *_: raw, target_table, state_table, folder, AS_OF)


def _landed(spark, d, kind):
    """The target's columns of the new events, as files in the shared folder."""
    path = work_dir(spark, kind) + f".{kind}"
    rows = events_staging(spark, d)
    rows.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").format("csv" if kind == "csv" else "json").save(path)
    return path


def _file_load(spark, d, kind):
    _, _, known, spec = _run_inputs(spark, d)
    spec = dataclasses.replace(spec, primary_key=("event_id",), incremental_column="ts", field_mappings=())
    return load.load_files(_landed(spark, d, kind), events_target(spark, d), spec, align_by_name(known, STATE_SCHEMA), AS_OF).target


@query("load_batch_ndjson", ORACLES["merge_upsert"])
def load_batch_ndjson(spark, d):
    return _file_load(spark, d, "ndjson")


@query("load_batch_csv", ORACLES["merge_upsert"])
def load_batch_csv(spark, d):
    return _file_load(spark, d, "csv")


def _broken(spark, d):
    """The target's columns of the new events as NDJSON in which some lines are no records and some values don't fit."""
    path = work_dir(spark, "broken") + ".ndjson"
    rows, i = events_staging(spark, d), F.col("event_id")
    wrong = {
        "event_id": F.when(i % 40 == 3, "none").otherwise(i.cast("string")),
        "ts": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "value": F.when(i % 30 == 7, "a lot").otherwise(F.col("value").cast("string")),
    }
    line = F.to_json(F.struct(*[wrong.get(c, F.col(c)).alias(c) for c in rows.columns]))
    rows.select(F.when(i % 50 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(path)
    return path


@query(
    "load_rejects",
    f"""WITH {STAGING}, told AS (SELECT count(*) AS n, count(*) FILTER (event_id % 50 = 0) AS bad,
        count(*) FILTER (event_id % 50 <> 0 AND event_id % 40 = 3) AS ids, count(*) FILTER (event_id % 50 <> 0 AND event_id % 30 = 7) AS vals,
        count(*) FILTER (event_id % 50 = 0 OR event_id % 40 = 3 OR event_id % 30 = 7) AS lines FROM stg)
    SELECT 'total_raw' AS what, n AS n_rows FROM told UNION ALL SELECT 'malformed', bad FROM told
    UNION ALL SELECT 'pk_missing', ids FROM told
    UNION ALL SELECT 'wrong event_id', ids FROM told UNION ALL SELECT 'wrong value', vals FROM told
    UNION ALL SELECT 'kept lines', lines FROM told UNION ALL SELECT 'raised', 1::BIGINT""",
)
def load_rejects(spark, d):
    """What a load of files tells about lines and values that are wrong, and that it raises unless it is to tolerate them."""
    _, _, known, spec = _run_inputs(spark, d)
    spec = dataclasses.replace(spec, primary_key=("event_id",), incremental_column="ts", field_mappings=())
    path, kept = _broken(spark, d), work_dir(spark, "rejects")
    target, state = events_target(spark, d), align_by_name(known, STATE_SCHEMA)
    result = load.load_files(path, target, spec, state, AS_OF, tolerate=None, rejects_folder=kept)
    try:
        load.load_files(path, target, spec, state, AS_OF)
        raised = 0
    except load.RejectedLines:
        raised = 1
    told = {c: F.col(c) for c in ("total_raw", "malformed", "pk_missing")}
    told |= {f"wrong {c}": F.col("wrong_values")[c] for c in ("event_id", "value")}
    cells = F.array(*[F.struct(F.lit(k).alias("what"), v.alias("n_rows")) for k, v in told.items()])
    lines = spark.read.parquet(kept).agg(F.lit("kept lines").alias("what"), F.count("*").alias("n_rows"))
    return result.stats.select(F.inline(cells)).unionByName(lines).unionByName(
        spark.range(1).select(F.lit("raised").alias("what"), F.lit(raised).cast("bigint").alias("n_rows"))
    )


@query(
    "execute_load_metadata",
    f"SELECT total_raw - pk_missing - watermark_skipped AS records_processed, pk_missing AS errors FROM ({ORACLES['run_load_state']})",
)
def execute_load_metadata(spark, d):
    return _executed(spark, d).metadata.select("records_processed", "errors")


@query("materialize_table", "SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id")
def materialize_table(spark, d):
    per_user = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n_events"))
    return S.materialize(per_user, f"strata_per_user_{work_dir(spark, 't').rsplit('-', 1)[1]}", "table")


@query("materialize_incremental", ORACLES["merge_upsert"])
def materialize_incremental(spark, d):
    folder = work_dir(spark, "models")
    name = f"strata_model_{folder.rsplit('-', 1)[1]}"
    S.materialize(events_target(spark, d), name, "incremental", folder=folder, unique_key=["event_id"], updated_at="ts")
    return S.materialize(events_staging(spark, d), name, "incremental", folder=folder, unique_key=["event_id"], updated_at="ts")


@query("materialize_snapshot", ORACLES["snapshot_timestamp"])
def materialize_snapshot(spark, d):
    folder = work_dir(spark, "models")
    name = f"strata_snapshot_{folder.rsplit('-', 1)[1]}"
    options = {"folder": folder, "unique_key": ["c_custkey"], "updated_at": "updated_at"}
    S.materialize(customer_v1(spark, d), name, "snapshot", run_ts="2024-01-11 00:00:00", **options)
    return S.materialize(customer_v2(spark, d), name, "snapshot", run_ts=AS_OF, **options)
