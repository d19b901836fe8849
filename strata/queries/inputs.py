"""Inputs derived from the given tables by fixed rules, each as a DataFrame and as a SQL CTE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import surrogate_key
from strata.functions.time import clock
from strata.queries.base import AS_OF, table


def raw_events(spark: SparkSession, d: str) -> DataFrame:
    """Events as nested records with text ids."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"),
        "ts",
        "user_id",
        "event_type",
        "value",
        F.struct(F.struct(k.alias("k")).alias("props"), F.col("user_id").alias("user")).alias("payload"),
    )


def dirty_events(spark: SparkSession, d: str) -> DataFrame:
    """Events with missing keys and zero dates."""
    i = F.col("event_id")
    key = F.when(i % 17 == 0, None).when(i % 19 == 0, "").otherwise(i.cast("string"))
    day = (
        F.when(i % 23 == 0, "0000-00-00")
        .when(i % 29 == 0, "0000-00-00 00:00:00")
        .when(i % 31 == 0, "")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return table(spark, d, "events").select(
        key.alias("id"), day.alias("created"), F.when(i % 37 == 0, "").otherwise(F.col("event_type")).alias("event_type"), "ts", "value"
    )


DIRTY = """dirty AS (
  SELECT CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS id,
    CASE WHEN event_id % 23 = 0 THEN '0000-00-00' WHEN event_id % 29 = 0 THEN '0000-00-00 00:00:00'
      WHEN event_id % 31 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS created,
    CASE WHEN event_id % 37 = 0 THEN '' ELSE event_type END AS event_type, ts, value
  FROM events)"""


# Added to a key to make it one the target does not have.
NEW_KEY = 1_000_000_000


def events_target(spark: SparkSession, d: str) -> DataFrame:
    """All events, as loaded the day before the clock."""
    return (
        table(spark, d, "events")
        .select("event_id", "ts", "user_id", "event_type", "value", F.lit("old").alias("note"))
        .withColumn("inserted_at", clock("2024-01-30 00:00:00"))
    )


TARGET = """tgt AS (
  SELECT event_id, ts, user_id, event_type, value, 'old' AS note, TIMESTAMP '2024-01-30 00:00:00' AS inserted_at
  FROM events)"""


def restage(events: DataFrame, tie: bool = False) -> DataFrame:
    """A batch made of all events: even ids come again with changed values, odd ids come as new ids.

    Every tenth id comes twice, the copy an hour older or, for ``tie``, at the same time.
    """
    i = F.col("event_id")
    copies = F.when(i % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.withColumn("copy", F.explode(copies))
    older = F.when(F.col("copy") == 1, F.col("ts") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))
    return rows.select(
        F.when(i % 2 == 0, i).otherwise(i + NEW_KEY).alias("event_id"),
        (F.col("ts") if tie else older).alias("ts"),
        "user_id",
        "event_type",
        F.when(i % 7 != 0, F.col("value") + 1 + 100 * F.col("copy")).alias("value"),
        clock(AS_OF).alias("inserted_at"),
    )


def events_staging(spark: SparkSession, d: str, tie: bool = False) -> DataFrame:
    return restage(table(spark, d, "events"), tie)


STAGING = """stg AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN event_id ELSE event_id + 1000000000 END AS event_id, ts, user_id, event_type,
    CASE WHEN event_id % 7 <> 0 THEN value + 1 END AS value, TIMESTAMP '2024-01-31 00:00:00' AS inserted_at FROM events
  UNION ALL
  SELECT event_id, ts - INTERVAL 1 HOUR, user_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value + 1 + 100 END,
    TIMESTAMP '2024-01-31 00:00:00' FROM events WHERE event_id % 10 = 0)"""
STAGING_TIE = STAGING.replace("ts - INTERVAL 1 HOUR", "ts").replace("stg AS", "stg_tie AS")

DEDUPED = """src AS (
  SELECT event_id, ts, user_id, event_type, value, inserted_at FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC NULLS LAST, user_id DESC NULLS LAST,
      event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn FROM stg) WHERE rn = 1)"""

# The upsert of src into tgt: matched, untouched and new rows.
MERGED = """merged AS (
  SELECT coalesce(t.event_id, s.event_id) AS event_id,
    CASE WHEN s.event_id IS NOT NULL THEN s.ts ELSE t.ts END AS ts,
    CASE WHEN s.event_id IS NOT NULL THEN s.user_id ELSE t.user_id END AS user_id,
    CASE WHEN s.event_id IS NOT NULL THEN s.event_type ELSE t.event_type END AS event_type,
    CASE WHEN s.event_id IS NOT NULL THEN s.value ELSE t.value END AS value,
    t.note, CASE WHEN t.event_id IS NOT NULL THEN t.inserted_at ELSE s.inserted_at END AS inserted_at
  FROM tgt t FULL OUTER JOIN src s ON t.event_id = s.event_id)"""


def watermarks(spark: SparkSession, d: str) -> DataFrame:
    """Load state with one row per event type, plus an outdated row each."""
    n = F.length("event_type") % 3
    newest = (
        table(spark, d, "events")
        .groupBy("event_type")
        .agg(F.max("ts").alias("top"), F.count("*").alias("rows_processed"))
        .select(
            F.lit("raw").alias("layer"),
            F.lit("raw_events").alias("target_schema"),
            F.col("event_type").alias("target_table"),
            F.date_format("top", "yyyy-MM-dd HH:mm:ss").alias("watermark_value"),
            "rows_processed",
            F.when(n == 0, "success").when(n == 1, "failed").otherwise("no_new_data").alias("status"),
            F.date_trunc("HOUR", "top").cast("timestamp_ntz").alias("last_run_at"),
            F.when(n != 1, F.date_trunc("HOUR", "top")).cast("timestamp_ntz").alias("last_success_at"),
            clock("2024-01-30 12:00:00").alias("updated_at"),
        )
    )
    older = newest.withColumns(
        {"watermark_value": F.lit("2024-01-01 00:00:00"), "updated_at": F.col("updated_at") - F.expr("INTERVAL 1 DAY")}
    )
    return newest.unionByName(older)


STATE_ALL = """state_new AS (
  SELECT 'raw' AS layer, 'raw_events' AS target_schema, event_type AS target_table,
    strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS watermark_value, count(*) AS rows_processed,
    CASE length(event_type) % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' ELSE 'no_new_data' END AS status,
    date_trunc('hour', max(ts)) AS last_run_at,
    CASE WHEN length(event_type) % 3 <> 1 THEN date_trunc('hour', max(ts)) END AS last_success_at,
    TIMESTAMP '2024-01-30 12:00:00' AS updated_at
  FROM events GROUP BY event_type),
state_all AS (
  SELECT * FROM state_new
  UNION ALL
  SELECT layer, target_schema, target_table, '2024-01-01 00:00:00', rows_processed, status, last_run_at,
    last_success_at, updated_at - INTERVAL 1 DAY FROM state_new)"""


def state(spark: SparkSession, d: str) -> DataFrame:
    """The current state rows only."""
    return watermarks(spark, d).filter(F.col("updated_at") == clock("2024-01-30 12:00:00"))


def customer_v1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal", clock("2024-01-10 00:00:00").alias("updated_at")
    )


def customer_v2(spark: SparkSession, d: str) -> DataFrame:
    """All customers again: changed segments, and some under a new key in place of the old one."""
    i = F.col("c_custkey")
    changed, moved = i % 5 == 0, i % 11 == 0
    return customer_v1(spark, d).select(
        F.when(moved, i + NEW_KEY).otherwise(i).alias("c_custkey"),
        "c_name",
        F.when(i % 10 == 0, F.lit("MOVED")).when(changed, None).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_acctbal",
        F.when(moved, clock("2024-01-25 00:00:00"))
        .when(changed, clock("2024-01-20 00:00:00"))
        .otherwise(F.col("updated_at"))
        .alias("updated_at"),
    )


CUSTOMERS = """v1 AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal, TIMESTAMP '2024-01-10 00:00:00' AS updated_at FROM customer),
v2 AS (
  SELECT CASE WHEN c_custkey % 11 = 0 THEN c_custkey + 1000000000 ELSE c_custkey END AS c_custkey, c_name,
    CASE WHEN c_custkey % 10 = 0 THEN 'MOVED' WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
    c_acctbal, CASE WHEN c_custkey % 11 = 0 THEN TIMESTAMP '2024-01-25 00:00:00'
      WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' ELSE updated_at END AS updated_at
  FROM v1)"""


def order_log(spark: SparkSession, d: str) -> DataFrame:
    """Orders read as a change log of their customers."""
    return table(spark, d, "orders").select(
        "o_custkey", F.col("o_orderdate").alias("changed_at"), "o_orderkey", "o_orderstatus", "o_orderpriority"
    )


ORDER_HISTORY = """versions AS (
  SELECT o_custkey, o_orderdate AS changed_at, o_orderkey, o_orderstatus, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1),
hist AS (
  SELECT *, changed_at AS valid_from,
    lead(changed_at) OVER (PARTITION BY o_custkey ORDER BY changed_at) AS valid_to FROM versions)"""


def stg_orders(spark: SparkSession, d: str) -> DataFrame:
    """Staging model of orders."""
    return table(spark, d, "orders").select(
        surrogate_key("o_orderkey").alias("order_sk"),
        surrogate_key("o_custkey").alias("customer_sk"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.lower(F.trim("o_orderstatus")).alias("order_status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("order_amount"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def dim_customer(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        surrogate_key("c_custkey").alias("customer_sk"),
        surrogate_key("c_nationkey").alias("nation_sk"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.lower(F.trim("c_mktsegment")).alias("customer_segment"),
    )


def dim_nation(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(
        surrogate_key("n_nationkey").alias("nation_sk"), F.col("n_name").alias("nation_name")
    )
