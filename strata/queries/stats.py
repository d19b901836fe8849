"""Counts, profiles, reshaping and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import audit, profile
from strata.operators.dedup import dedup_latest, latest_first, latest_state, top_per_key
from strata.operators.incremental import detect_strategy, max_watermark
from strata.operators.joins import fk_orphans, left_join_agg
from strata.queries.base import AS_OF, query, table
from strata.queries.inputs import (
    CUSTOMERS,
    DIRTY,
    STAGING,
    STAGING_TIE,
    STATE_ALL,
    customer_v1,
    customer_v2,
    dirty_events,
    events_staging,
    watermarks,
)


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, d):
    return A.row_count(table(spark, d, "lineitem"))


_LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query(
    "column_stats",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count FROM lineitem"
        for c, t in _LINEITEM_TYPES.items()
    ),
)
def column_stats(spark, d):
    return A.column_stats(table(spark, d, "lineitem").select(*_LINEITEM_TYPES))


@query(
    "max_watermark",
    "SELECT max(ts) AS max_value, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS watermark_value FROM events",
)
def max_watermark_(spark, d):
    top = max_watermark(table(spark, d, "events"), "ts")
    return top.withColumn("watermark_value", F.date_format("max_value", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("date_range_stats", "SELECT min(ts) AS date_range_min, max(ts) AS date_range_max FROM events")
def date_range_stats(spark, d):
    return A.range_stats(table(spark, d, "events"), "ts")


@query(
    "value_counts",
    """SELECT coalesce(NULLIF(source, 'src0'), 'NULL') AS value, count(*) AS n_rows FROM documents
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def value_counts(spark, d):
    docs = table(spark, d, "documents").select(F.nullif("source", F.lit("src0")).alias("source"))
    return A.value_counts(docs, "source")


@query(
    "null_profile",
    f"""WITH {DIRTY}
    SELECT 'id' AS column_name, count(*) FILTER (id IS NULL OR id = '') AS null_count,
      count(*) FILTER (id <> '') AS present_count FROM dirty
    UNION ALL SELECT 'event_type', count(*) FILTER (event_type = ''), count(*) FILTER (event_type <> '') FROM dirty
    UNION ALL SELECT 'value', count(*) - count(value), count(value) FROM dirty""",
)
def null_profile(spark, d):
    return A.null_profile(dirty_events(spark, d), ["id", "event_type", "value"])


@query(
    "entity_counts",
    "SELECT o_custkey, count(o_orderkey) AS total_count, count(DISTINCT o_orderpriority) AS distinct_count FROM orders GROUP BY 1",
)
def entity_counts(spark, d):
    return A.entity_counts(table(spark, d, "orders"), "o_custkey", "o_orderkey", "o_orderpriority")


@query("dup_groups", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_groups(spark, d):
    return A.dup_groups(table(spark, d, "lineitem"), "l_orderkey,l_linenumber")


# Types with a column of their own; all others, NULL included, are counted in n_other.
_TYPES = ("click", "error", "purchase", "signup")
_COUNTS = ", ".join(f"count(*) FILTER (event_type = '{t}') AS n_{t}" for t in _TYPES) + (
    f", count(*) FILTER (event_type IS NULL OR event_type NOT IN {_TYPES}) AS n_other"
)
_METRICS = [f"n_{t}" for t in (*_TYPES, "other")]


@query(
    "pivot_metrics",
    f"SELECT user_id, {_COUNTS} FROM events GROUP BY user_id",
)
def pivot_metrics(spark, d):
    return A.pivot_metrics(table(spark, d, "events"), "user_id", "event_type", _TYPES, "n_", "other")


@query(
    "unpivot_metrics",
    f"WITH wide AS (SELECT user_id, {_COUNTS} FROM events GROUP BY user_id) "
    + " UNION ALL ".join(f"SELECT user_id, '{m}' AS metric, {m} AS value FROM wide" for m in _METRICS),
)
def unpivot_metrics(spark, d):
    return A.unpivot_metrics(pivot_metrics(spark, d), "user_id", _METRICS)


@query(
    "dedup_latest",
    f"""WITH {STAGING} SELECT event_id, ts, user_id, event_type, value, inserted_at FROM (
      SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC NULLS LAST, user_id DESC NULLS LAST,
        event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn FROM stg) WHERE rn = 1""",
)
def dedup_latest_(spark, d):
    return dedup_latest(events_staging(spark, d), "event_id", "ts")


@query(
    "dedup_latest_tie",
    f"""WITH {STAGING_TIE} SELECT event_id, ts, user_id, event_type, value, inserted_at FROM (
      SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC NULLS LAST, user_id DESC NULLS LAST,
        event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn FROM stg_tie) WHERE rn = 1""",
)
def dedup_latest_tie(spark, d):
    return dedup_latest(events_staging(spark, d, tie=True), "event_id", "ts")


@query(
    "latest_per_key_qualify",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 3""",
)
def latest_per_key_qualify(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return top_per_key(orders, "o_custkey", latest_first(orders, ["o_custkey"], ["o_orderdate"]), 3)


@query(
    "latest_state",
    f"""WITH {STATE_ALL} SELECT target_table, watermark_value, status, rows_processed FROM (
      SELECT *, row_number() OVER (PARTITION BY layer, target_schema, target_table ORDER BY updated_at DESC) AS rn
      FROM state_all) WHERE rn = 1""",
)
def latest_state_(spark, d):
    return latest_state(watermarks(spark, d)).select("target_table", "watermark_value", "status", "rows_processed")


@query(
    "sample_rows",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
      CASE WHEN length(text) > 40 THEN left(text, 40) || '...' ELSE text END AS text, coalesce(lang, '') AS lang
    FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 5)""",
)
def sample_rows(spark, d):
    return profile.sample_rows(table(spark, d, "documents").select("doc_id", "text", "lang"), 5, "doc_id")


@query(
    "cte_left_join_agg",
    """SELECT c.c_custkey, c.c_name, o.total_orders, o.unique_priorities FROM customer c LEFT JOIN (
      SELECT o_custkey - o_custkey % 4 AS o_custkey, count(o_orderkey) AS total_orders,
        count(DISTINCT o_orderpriority) AS unique_priorities
      FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey""",
)
def cte_left_join_agg(spark, d):
    # All orders go to every fourth customer, so the others have none.
    k = F.col("o_custkey")
    orders = table(spark, d, "orders").withColumn("c_custkey", k - k % 4)
    counts = [
        F.count("o_orderkey").alias("total_orders"),
        F.count_distinct("o_orderpriority").alias("unique_priorities"),
    ]
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    return left_join_agg(customers, orders, "c_custkey", counts)


@query(
    "fk_orphans",
    """SELECT fk AS o_custkey, count(*) AS n_rows FROM (
      SELECT CASE WHEN o_orderkey % 13 = 0 THEN -1 WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS fk FROM orders)
    WHERE fk IS NOT NULL AND fk NOT IN (SELECT c_custkey FROM customer) GROUP BY 1""",
)
def fk_orphans_(spark, d):
    return fk_orphans(orphaned_orders(spark, d), "o_custkey", table(spark, d, "customer"), "c_custkey")


def orphaned_orders(spark, d):
    k = F.col("o_orderkey")
    fk = F.when(k % 13 == 0, -1).when(k % 17 == 0, None).otherwise(F.col("o_custkey")).cast("bigint")
    return table(spark, d, "orders").withColumn("o_custkey", fk)


_COMPARED = ("c_name", "c_mktsegment", "c_acctbal", "updated_at")


@query(
    "audit_compare",
    f"WITH {CUSTOMERS}, j AS (SELECT v1.c_custkey AS ka, v2.c_custkey AS kb, "
    + ", ".join(f"v1.{c} AS a_{c}, v2.{c} AS b_{c}" for c in _COMPARED)
    + """ FROM v1 FULL OUTER JOIN v2 ON v1.c_custkey = v2.c_custkey),
    m AS (SELECT * FROM j WHERE ka IS NOT NULL AND kb IS NOT NULL)
    SELECT '*' AS column_name, 'matched' AS outcome, count(*) AS n_rows FROM m
    UNION ALL SELECT '*', 'a_only', count(*) FROM j WHERE kb IS NULL
    UNION ALL SELECT '*', 'b_only', count(*) FROM j WHERE ka IS NULL
    UNION ALL SELECT '*', 'key_not_unique', 0"""
    + "".join(
        f" UNION ALL SELECT '{c}', '{outcome}', count(*) FROM m WHERE {condition}"
        for c in _COMPARED
        for outcome, condition in (
            ("equal", f"a_{c} = b_{c}"),
            ("both_null", f"a_{c} IS NULL AND b_{c} IS NULL"),
            ("null_in_a", f"a_{c} IS NULL AND b_{c} IS NOT NULL"),
            ("null_in_b", f"a_{c} IS NOT NULL AND b_{c} IS NULL"),
            ("different", f"a_{c} <> b_{c}"),
        )
    ),
)
def audit_compare(spark, d):
    return audit.audit_compare(customer_v1(spark, d), customer_v2(spark, d), "c_custkey")


@query(
    "audit_except",
    """WITH b AS (SELECT * REPLACE (CASE WHEN l_partkey % 50 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag) FROM lineitem)
    SELECT *, 'a_only' AS side, count(*) AS n_rows FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM b) GROUP BY ALL
    UNION ALL BY NAME
    SELECT *, 'b_only' AS side, count(*) AS n_rows FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM lineitem) GROUP BY ALL""",
)
def audit_except(spark, d):
    lines = table(spark, d, "lineitem")
    changed = lines.withColumn("l_returnflag", F.when(F.col("l_partkey") % 50 == 0, "X").otherwise(F.col("l_returnflag")))
    return audit.audit_except(lines, changed)


@query(
    "detect_strategy",
    """SELECT 'timestamp' AS strategy, 'updated_at' AS column_name, 'updated' AS column_kind, 'high' AS confidence,
      count(*) AS n_rows FROM orders
    UNION ALL SELECT 'timestamp', 'created_at', 'created', 'medium', count(*) FROM orders
    UNION ALL SELECT 'incremental_id', 'o_orderkey', 'id', 'medium', count(*) FROM orders
    UNION ALL SELECT CASE WHEN count(*) < 10000 THEN 'full_refresh' ELSE 'needs_discussion' END, NULL,
      CASE WHEN count(*) < 10000 THEN 'full' ELSE 'custom' END, CASE WHEN count(*) < 10000 THEN 'high' ELSE 'low' END,
      count(*) FROM orders
    UNION ALL SELECT CASE WHEN count(*) < 10000 THEN 'full_refresh' ELSE 'needs_discussion' END, NULL,
      CASE WHEN count(*) < 10000 THEN 'full' ELSE 'custom' END, CASE WHEN count(*) < 10000 THEN 'high' ELSE 'low' END,
      count(*) FROM customer""",
)
def detect_strategy_(spark, d):
    orders = table(spark, d, "orders")
    updated = orders.withColumnsRenamed({"o_orderdate": "UPDATED_AT"}).withColumnRenamed("UPDATED_AT", "updated_at")
    cases = [
        detect_strategy(updated, "o_orderkey"),
        detect_strategy(orders.withColumnRenamed("o_orderdate", "created_at"), "o_orderkey"),
        detect_strategy(orders, "o_orderkey"),
        detect_strategy(orders),
        detect_strategy(table(spark, d, "customer"), "c_name"),
    ]
    out = cases[0]
    for case in cases[1:]:
        out = out.unionByName(case)
    return out


_PAIRS = ("event_id", "ts", "user_id", "event_type", "value", "props")


@query(
    "candidate_keys",
    "WITH e AS (SELECT * FROM events), n AS (SELECT count(*) AS n_rows FROM e), one AS ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS key_columns, 1 AS n_columns, count(DISTINCT {a}) AS k FROM e HAVING count(DISTINCT {a}) = count(*)"
        for a in _PAIRS
    )
    + "), two AS ("
    + " UNION ALL ".join(
        f"SELECT '{a},{b}' AS key_columns, 2 AS n_columns, count(DISTINCT ({a}, {b})) AS k FROM e"
        for i, a in enumerate(_PAIRS)
        for b in _PAIRS[i + 1 :]
    )
    + ") SELECT key_columns, n_columns, n_rows FROM one, n UNION ALL "
    "SELECT key_columns, n_columns, n_rows FROM two, n WHERE k = n_rows AND NOT EXISTS (SELECT 1 FROM one)",
)
def candidate_keys(spark, d):
    return profile.candidate_keys(table(spark, d, "events"))


@query(
    "run_metadata",
    """SELECT 100 + count(*) AS row_count, count(*) AS row_count_delta, count(*) AS records_processed, 7::BIGINT AS errors,
      count(*) + 7 AS raw_records_fetched, '2024-01-02' AS watermark_before,
      CAST(max(event_id) AS VARCHAR) AS watermark_after, CAST(min(event_id) AS VARCHAR) AS date_range_min,
      CAST(max(event_id) AS VARCHAR) AS date_range_max, 36.5::DOUBLE AS hours_since_last_run FROM events""",
)
def run_metadata(spark, d):
    return profile.run_metadata(
        table(spark, d, "events"), 7, 100, "2024-01-02", "event_id", AS_OF, "2024-01-29 11:30:00"
    )


@query(
    "custom_metadata",
    f"""WITH {DIRTY}, n AS (SELECT event_type AS v, count(*) AS n FROM dirty GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20),
    t AS (SELECT string_agg(v || ': ' || n, ', ' ORDER BY n DESC, v) AS s FROM n)
    SELECT 'id_null' AS metadata_key, CAST(count(*) FILTER (id IS NULL OR id = '') AS VARCHAR) AS metadata_value FROM dirty
    UNION ALL SELECT 'id_present', CAST(count(*) FILTER (id <> '') AS VARCHAR) FROM dirty
    UNION ALL SELECT 'event_type_distribution', s FROM t
    UNION ALL SELECT 'row_count_by_event_type', s FROM t""",
)
def custom_metadata(spark, d):
    declared = [
        {"column": "id", "type": "null_count"},
        {"column": "event_type", "type": "value_counts"},
        {"type": "row_count_by_event_type"},
    ]
    return profile.custom_metadata(dirty_events(spark, d), declared)
