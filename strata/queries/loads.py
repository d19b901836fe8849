"""Aligning, merging, incremental windows, load state and whole loads."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import align, merge
from strata.operators import incremental as I
from strata.operators import watermarks as W
from strata.plans import load
from strata.queries.base import AS_OF, query, table
from strata.queries.inputs import (
    DEDUPED,
    MERGED,
    NEW_KEY,
    STAGING,
    STATE_ALL,
    TARGET,
    events_staging,
    events_target,
    raw_events,
    state,
    watermarks,
)
from strata.session import staged
from strata.specs import FieldMapping, LoadSpec


@query(
    "column_intersect",
    "SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id FROM events",
)
def column_intersect(spark, d):
    batch = table(spark, d, "events").select(
        F.col("user_id").alias("USER_ID"), F.col("event_id"), F.col("ts").alias("Ts"), F.lit(1).alias("unknown")
    )
    target = T.StructType.fromDDL("event_id bigint, ts timestamp_ntz, user_id string, never_sent double")
    return align.column_intersect(batch, target)


@query(
    "json_encode_nested",
    """SELECT CAST(event_id AS VARCHAR) AS id, '{"props":{"k":' || json_extract_string(props, '$.k') || '},"user":'
      || CAST(user_id AS VARCHAR) || '}' AS payload, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
)
def json_encode_nested(spark, d):
    raw = raw_events(spark, d).select("id", "payload", F.struct(F.col("payload.props.k").alias("k")).alias("kept"))
    target = T.StructType.fromDDL("id string, payload string, kept struct<k: int>")
    return align.json_encode_nested(raw, target).select("id", "payload", F.col("kept.k").alias("k"))


@query(
    "bulk_load_by_name",
    """SELECT event_id, ts, event_type, CAST(NULL AS VARCHAR) AS note, value FROM events""",
)
def bulk_load_by_name(spark, d):
    target = T.StructType.fromDDL("event_id bigint, ts timestamp_ntz, event_type string, note string, value double")
    batch = table(spark, d, "events").select("value", F.col("event_type").alias("EVENT_TYPE"), "ts", "event_id", "props")
    return align.align_by_name(batch, target)


@query(
    "full_refresh",
    f"""WITH {STAGING}, {DEDUPED} SELECT event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS note, inserted_at FROM src""",
)
def full_refresh(spark, d):
    return merge.full_refresh(events_target(spark, d), events_staging(spark, d), "event_id", "ts")


@query(
    "table_backfill",
    """SELECT o_orderkey, o_custkey, o_orderdate AS updated_at, TIMESTAMP '2024-01-31 00:00:00' AS inserted_at FROM orders""",
)
def table_backfill(spark, d):
    source = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").alias("updated_at"), F.lit("x").alias("_airbyte_meta")
    )
    return merge.table_backfill(source, AS_OF)


_UPSERT = f"WITH {TARGET}, {STAGING}, {DEDUPED}, {MERGED} SELECT * FROM merged"


@query("merge_upsert", _UPSERT)
def merge_upsert(spark, d):
    return merge.merge_upsert(events_target(spark, d), events_staging(spark, d), "event_id", "ts")


@query("merge_upsert_small_batch", _UPSERT)
def merge_upsert_small_batch(spark, d):
    batch = staged(events_staging(spark, d))
    return merge.merge_upsert(events_target(spark, d), batch, "event_id", "ts", small_batch=True)


@query(
    "merge_upsert_null_keys",
    f"""WITH {TARGET}, {STAGING}, t AS (SELECT CASE WHEN event_id % 4 = 1 THEN NULL ELSE event_id END AS event_id, user_id, event_type FROM tgt),
    s AS (SELECT CASE WHEN event_id % 8 = 0 THEN NULL ELSE event_id END AS event_id, user_id % 10 AS user_id, max(event_type) AS event_type
      FROM stg GROUP BY ALL)
    SELECT s.event_id, s.user_id, s.event_type FROM t JOIN s ON t.event_id = s.event_id AND t.user_id = s.user_id
    UNION ALL SELECT t.event_id, t.user_id, t.event_type FROM t WHERE NOT EXISTS (
      SELECT 1 FROM s WHERE s.event_id = t.event_id AND s.user_id = t.user_id)
    UNION ALL SELECT s.event_id, s.user_id, s.event_type FROM s WHERE NOT EXISTS (
      SELECT 1 FROM t WHERE s.event_id = t.event_id AND s.user_id = t.user_id)""",
)
def merge_upsert_null_keys(spark, d):
    i = F.col("event_id")
    target = events_target(spark, d).select(
        F.when(i % 4 != 1, i).alias("event_id"), "user_id", "event_type"
    )
    batch = events_staging(spark, d).select(
        F.when(i % 8 != 0, i).alias("event_id"), (F.col("user_id") % 10).alias("user_id"), "event_type"
    )
    return merge.merge_upsert(target, batch, "event_id,user_id", "event_type")


def _spec(**options) -> LoadSpec:
    fixed = {"incremental_strategy": "timestamp", "incremental_column": "ts", **options}
    return LoadSpec("events", "raw_events", "events", ("event_id",), **fixed)


@query(
    "load_batch",
    f"""WITH {TARGET}, {STAGING}, {DEDUPED}, {MERGED}
    SELECT 'table' AS part, count(*) AS n_rows, max(ts) AS high, count(value) AS n_values FROM merged
    UNION ALL SELECT 'state', max(n), max(high), 0 FROM (SELECT count(*) AS n, max(ts) AS high FROM stg)
    UNION ALL SELECT 'replaced', count(*), max(ts), count(value) FROM src""",
)
def load_batch(spark, d):
    target, batch = events_target(spark, d), events_staging(spark, d)
    no_state = align.staging_like(spark, W.STATE_SCHEMA)
    upserted = load.load_batch(target, batch, _spec(), no_state, AS_OF)
    replaced = load.load_batch(target, batch, _spec(incremental_strategy="full_refresh"), no_state, AS_OF)

    def summary(part, df):
        return df.agg(
            F.lit(part).alias("part"), F.count("*").alias("n_rows"), F.max("ts").alias("high"), F.count("value").alias("n_values")
        )

    kept = upserted.state.select(
        F.lit("state").alias("part"),
        F.col("rows_processed").alias("n_rows"),
        F.col("watermark_value").cast("timestamp_ntz").alias("high"),
        F.lit(0).cast("bigint").alias("n_values"),
    )
    return summary("table", upserted.target).unionByName(kept).unionByName(summary("replaced", replaced.target))


@query(
    "incremental_lookback",
    """SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00') - INTERVAL 3 DAY""",
)
def incremental_lookback(spark, d):
    rows = table(spark, d, "events").select("event_id", "ts")
    loaded = rows.filter(F.col("ts") < F.lit("2024-01-25").cast("timestamp_ntz"))
    return I.lookback(rows, "ts", I.high_water(loaded, "ts"))


@query(
    "incremental_window",
    """SELECT 'backfill' AS chosen, count(*) AS n_rows FROM events
      WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-08 00:00:00'
    UNION ALL SELECT 'lookback', count(*) FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY
    UNION ALL SELECT 'recent', count(*) FROM events WHERE ts >= DATE '2024-01-31' - 7""",
)
def incremental_window(spark, d):
    rows = table(spark, d, "events").select("ts")
    high = I.high_water(rows, "ts")
    choices = {
        "backfill": {"backfill": ("2024-01-05", "2024-01-08"), "target_high": high},
        "lookback": {"target_high": high, "dev_days": 7},
        "recent": {"dev_days": 7},
    }
    out = None
    for name, choice in choices.items():
        part = I.incremental_window(rows, "ts", AS_OF, **choice).agg(
            F.lit(name).alias("chosen"), F.count("*").alias("n_rows")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "append_new_columns",
    f"""WITH {TARGET}, {STAGING}, {DEDUPED}, {MERGED}
    SELECT m.*, CASE WHEN s.event_id IS NOT NULL THEN 'v2' END AS version FROM merged m LEFT JOIN src s ON m.event_id = s.event_id""",
)
def append_new_columns(spark, d):
    batch = events_staging(spark, d).withColumn("version", F.lit("v2"))
    return merge.merge_upsert(events_target(spark, d), batch, "event_id", "ts", new_columns=True)


@query("incremental_id", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey > 1200")
def incremental_id(spark, d):
    return I.incremental_id(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey", 1200)


_MAPPED_SQL = """raw AS (
  SELECT CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 3 = 0 THEN event_id + 1000000000 ELSE event_id END AS event_id,
    ts, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
fresh AS (SELECT event_id, ts, user_id, k FROM raw WHERE event_id IS NOT NULL AND ts > TIMESTAMP '2024-01-20 00:00:00'),
old AS (SELECT event_id, ts, user_id, -1 AS k, TIMESTAMP '2024-01-20 00:00:00' AS inserted_at,
  TIMESTAMP '2024-01-20 00:00:00' AS updated_at FROM events)"""


def _run_inputs(spark, d):
    i = F.col("id").cast("bigint")
    key = F.when(i % 17 == 0, None).when(i % 3 == 0, i + NEW_KEY).otherwise(i)
    raw = raw_events(spark, d).withColumn("id", key)
    stamp = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    target = table(spark, d, "events").select(
        "event_id", "ts", "user_id", F.lit(-1).alias("k"), stamp.alias("inserted_at"), stamp.alias("updated_at")
    )
    spec = _spec(
        field_mappings=(
            FieldMapping("id", "event_id"),
            FieldMapping("ts", "ts"),
            FieldMapping("payload.user", "user_id"),
            FieldMapping("payload.props.k", "k"),
        )
    )
    known = spark.range(1).select(
        F.lit("raw").alias("layer"),
        F.lit("raw_events").alias("target_schema"),
        F.lit("events").alias("target_table"),
        F.lit("2024-01-20 00:00:00").alias("watermark_value"),
        stamp.alias("updated_at"),
    )
    return raw, target, align.align_by_name(known, W.STATE_SCHEMA), spec


@query(
    "run_load",
    f"""WITH {_MAPPED_SQL} SELECT coalesce(o.event_id, f.event_id) AS event_id, coalesce(f.ts, o.ts) AS ts,
      coalesce(f.user_id, o.user_id) AS user_id, CASE WHEN f.event_id IS NOT NULL THEN f.k ELSE o.k END AS k,
      coalesce(o.inserted_at, TIMESTAMP '2024-01-31 00:00:00') AS inserted_at,
      CASE WHEN f.event_id IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE o.updated_at END AS updated_at
    FROM old o FULL OUTER JOIN fresh f ON o.event_id = f.event_id""",
)
def run_load(spark, d):
    raw, target, known, spec = _run_inputs(spark, d)
    return load.run_load(raw, target, known, spec, AS_OF, stage=True).target


@query(
    "run_load_state",
    f"""WITH {_MAPPED_SQL} SELECT 'events' AS target_table, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS watermark_value,
      count(*) AS rows_processed, 'success' AS status, TIMESTAMP '2024-01-31 00:00:00' AS last_success_at,
      (SELECT count(*) FROM raw) AS total_raw, (SELECT count(*) - count(event_id) FROM raw) AS pk_missing,
      (SELECT count(*) FROM raw WHERE event_id IS NOT NULL AND ts <= TIMESTAMP '2024-01-20 00:00:00') AS watermark_skipped
    FROM fresh""",
)
def run_load_state(spark, d):
    raw, target, known, spec = _run_inputs(spark, d)
    result = load.run_load(raw, target, known, spec, AS_OF)
    key = ["layer", "target_schema", "target_table"]
    row = result.state.select(
        *key,
        F.substring("watermark_value", 1, 19).alias("watermark_value"),
        "rows_processed",
        "status",
        "last_success_at",
    )
    own = dict(zip(key, (spec.layer, spec.target_schema, spec.target_table)))
    stats = result.stats.drop("mapped").withColumns({k: F.lit(v) for k, v in own.items()})
    return row.join(stats, key).drop("layer", "target_schema")


_KEY = "layer, target_schema, target_table"


@query(
    "watermark_get",
    f"WITH {STATE_ALL} SELECT {_KEY}, watermark_value, last_run_at, status FROM state_new",
)
def watermark_get(spark, d):
    return W.watermark_get(watermarks(spark, d))


_STATE_COLUMNS = (*W.STATE_KEY, "watermark_value", "rows_processed", "status", "last_run_at", "last_success_at", "error_message", "updated_at")
_NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def _updates(spark, d):
    """New watermarks for two known tables and for tables without a state row."""
    found = (
        table(spark, d, "events")
        .groupBy("event_type")
        .agg(F.count("*").alias("rows_processed"), F.max("event_id").cast("string").alias("watermark_value"))
    )
    kind = F.col("event_type")
    named = F.when(kind.isin("click", "error"), kind).otherwise(F.concat(kind, F.lit("_new")))
    return W.state_rows(found, "raw", "raw_events", named, [F.col("rows_processed"), F.col("watermark_value")])


_UPDATES = """u AS (
      SELECT CASE WHEN event_type IN ('click', 'error') THEN event_type ELSE event_type || '_new' END AS t,
        count(*) AS n, CAST(max(event_id) AS VARCHAR) AS w,
        CASE WHEN event_type = 'error' THEN 'no_new_data' ELSE 'failed' END AS s
      FROM events GROUP BY event_type)"""


@query(
    "watermark_update",
    f"""WITH {STATE_ALL}, {_UPDATES}
    SELECT {_KEY}, watermark_value, rows_processed, status, last_run_at, last_success_at, CAST(NULL AS VARCHAR) AS error_message, updated_at
    FROM state_new WHERE target_table NOT IN (SELECT t FROM u)
    UNION ALL SELECT 'raw', 'raw_events', t, w, n, 'success', {_NOW}, {_NOW}, NULL, {_NOW} FROM u""",
)
def watermark_update(spark, d):
    return W.watermark_update(state(spark, d), _updates(spark, d), AS_OF).select(*_STATE_COLUMNS)


@query(
    "watermark_mark_started",
    f"""WITH {STATE_ALL} SELECT target_table, CASE WHEN target_table IN ('click', 'error') THEN {_NOW} ELSE last_run_at END AS last_run_at,
      CASE WHEN target_table IN ('click', 'error') THEN {_NOW} ELSE updated_at END AS updated_at, last_success_at FROM state_new""",
)
def watermark_mark_started(spark, d):
    started = _updates(spark, d).select(*W.STATE_KEY)
    after = W.watermark_mark_started(state(spark, d), started, AS_OF)
    return after.select("target_table", "last_run_at", "updated_at", "last_success_at")


@query(
    "watermark_set_status",
    f"""WITH {STATE_ALL}, {_UPDATES}
    SELECT {_KEY}, watermark_value, rows_processed, coalesce(s, status) AS status,
      CASE WHEN s IS NOT NULL THEN {_NOW} ELSE last_run_at END AS last_run_at,
      CASE WHEN s = 'no_new_data' THEN {_NOW} ELSE last_success_at END AS last_success_at,
      CASE WHEN s IS NOT NULL THEN repeat('x', 500) END AS error_message,
      CASE WHEN s IS NOT NULL THEN {_NOW} ELSE updated_at END AS updated_at
    FROM state_new LEFT JOIN u ON target_table = t
    UNION ALL SELECT 'raw', 'raw_events', t, NULL, 0, s, {_NOW}, NULL, repeat('x', 500), {_NOW} FROM u WHERE t LIKE '%_new'""",
)
def watermark_set_status(spark, d):
    name = F.col("target_table")
    statuses = _updates(spark, d).select(
        *W.STATE_KEY,
        F.when(name == "error", "no_new_data").otherwise("failed").alias("status"),
        F.repeat(F.lit("x"), F.lit(700)).alias("error_message"),
    )
    return W.watermark_set_status(state(spark, d), statuses, AS_OF).select(*_STATE_COLUMNS)
