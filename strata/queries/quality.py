"""Data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.time import clock
from strata.operators import quality as Q
from strata.operators.align import missing_columns
from strata.queries.base import AS_OF, query, table
from strata.queries.inputs import (
    DIRTY,
    STAGING,
    STATE_ALL,
    dirty_events,
    events_staging,
    state,
)
from strata.queries.stats import orphaned_orders
from strata.specs import FieldMapping, LoadSpec


def _sql(name: str, metric: str, passed: str, value: str, rest: str, severity: str = "ERROR") -> str:
    return (
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, {passed} AS passed, '{metric}' AS metric, "
        f"CAST({value} AS VARCHAR) AS value {rest}"
    )


@query("check_zero_rows", _sql("zero_rows", "row_count", "count(*) > 0", "count(*)", "FROM lineitem"))
def check_zero_rows(spark, d):
    return Q.run_checks(table(spark, d, "lineitem"), [Q.zero_rows()])


@query(
    "check_duplicate_pk",
    _sql(
        "duplicate_pk", "duplicate_pk_groups", "count(*) = 0", "count(*)",
        "FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)",
    ),
)
def check_duplicate_pk(spark, d):
    return Q.check_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_null_pk",
    f"WITH {DIRTY} " + _sql("null_pk", "null_pk_count", "count(*) = 0", "count(*)", "FROM dirty WHERE id IS NULL OR ts IS NULL"),
)
def check_null_pk(spark, d):
    return Q.run_checks(dirty_events(spark, d), [Q.null_pk("id,ts")])


@query(
    "check_freshness",
    f"""WITH {STATE_ALL} SELECT target_table || '_freshness' AS check_name, 'WARN' AS severity,
      coalesce(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_success_at) <= 1.5 * 3600000000, true) AS passed,
      'hours_since_last_success' AS metric,
      CAST(round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_success_at)) / 3600000000.0, 1) AS VARCHAR) AS value
    FROM state_new""",
)
def check_freshness(spark, d):
    return Q.check_freshness(state(spark, d), AS_OF, F.lit(1.5))


@query(
    "check_schema",
    """SELECT 'schema' AS check_name, 'WARN' AS severity, false AS passed, 'missing_columns' AS metric,
      'missing: created, kind; expected 4, found 2' AS value FROM events HAVING count(*) > 0""",
)
def check_schema(spark, d):
    return Q.check_schema(table(spark, d, "events"), ["EVENT_ID", "ts", "kind", "created"])


@query(
    "missing_columns",
    """SELECT 'created, kind' AS missing_columns, 'event_id, ts' AS found_columns, count(*) AS row_count FROM events""",
)
def missing_columns_(spark, d):
    events = table(spark, d, "events")
    absent, present = missing_columns(events, ["event_id", "ts", "kind", "created"])
    return events.agg(
        F.lit(", ".join(absent)).alias("missing_columns"),
        F.lit(", ".join(present)).alias("found_columns"),
        F.count("*").alias("row_count"),
    )


@query(
    "test_unique",
    _sql(
        "unique_l_partkey", "duplicate_count", "count(*) = 0", "count(*)",
        "FROM (SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    ),
)
def test_unique(spark, d):
    return Q.check_unique(table(spark, d, "lineitem"), "l_partkey")


@query(
    "test_not_null",
    f"WITH {STAGING} " + _sql("not_null_value", "null_count", "count(*) = count(value)", "count(*) - count(value)", "FROM stg"),
)
def test_not_null(spark, d):
    return Q.run_checks(events_staging(spark, d), [Q.not_null("value")])


@query(
    "test_accepted_values",
    _sql(
        "accepted_values_o_orderstatus", "rejected_count", "count(*) = 0", "count(*)",
        "FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
    ),
)
def test_accepted_values(spark, d):
    return Q.run_checks(table(spark, d, "orders"), [Q.accepted_values("o_orderstatus", ["F", "O"])])


@query(
    "test_relationships",
    _sql(
        "relationships_o_custkey", "orphan_count", "count(*) = 0", "count(*)",
        """FROM (SELECT CASE WHEN o_orderkey % 13 = 0 THEN -1 WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS fk
        FROM orders) WHERE fk IS NOT NULL AND fk NOT IN (SELECT c_custkey FROM customer)""",
    ),
)
def test_relationships(spark, d):
    return Q.check_relationships(orphaned_orders(spark, d), "o_custkey", table(spark, d, "customer"), "c_custkey")


@query(
    "model_contract",
    "SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS balance FROM customer",
)
def model_contract(spark, d):
    model = table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_acctbal").alias("balance")
    )
    return Q.assert_contract(model, {"customer_id": "bigint", "customer_name": "string", "balance": "double"})


@query(
    "test_row_count_between",
    _sql("row_count_between", "row_count", "count(*) BETWEEN 1000 AND 10000000", "count(*)", "FROM orders"),
)
def test_row_count_between(spark, d):
    return Q.run_checks(table(spark, d, "orders"), [Q.row_count_between(1000, 10000000)])


@query(
    "test_regex",
    _sql("regex_url", "unmatched_count", "count(*) = 0", "count(*)", "FROM pages WHERE NOT regexp_matches(url, '^https://[a-z.]+/')"),
)
def test_regex(spark, d):
    return Q.run_checks(table(spark, d, "pages"), [Q.matches("url", "^https://[a-z.]+/")])


@query(
    "column_tests_one_scan",
    " UNION ALL ".join(
        [
            _sql("zero_rows", "row_count", "count(*) > 0", "count(*)", "FROM orders"),
            _sql("null_pk", "null_pk_count", "count(*) = count(o_orderkey)", "count(*) - count(o_orderkey)", "FROM orders"),
            _sql("accepted_values_o_orderstatus", "rejected_count", "count(*) = 0", "count(*)", "FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')"),
            _sql("regex_o_orderpriority", "unmatched_count", "count(*) = 0", "count(*)", "FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-')"),
        ]
    ),
)
def column_tests_one_scan(spark, d):
    checks = [
        Q.zero_rows(),
        Q.null_pk("o_orderkey"),
        Q.accepted_values("o_orderstatus", ["F", "O", "P"]),
        Q.matches("o_orderpriority", "^[1-5]-"),
    ]
    return Q.run_checks(table(spark, d, "orders"), checks)


@query(
    "table_checks",
    f"WITH {STAGING}, {STATE_ALL} "
    + " UNION ALL ".join(
        [
            _sql("view_zero_rows", "row_count", "count(*) > 0", "count(*)", "FROM stg"),
            _sql("view_null_pk", "null_pk_count", "count(*) = count(event_id)", "count(*) - count(event_id)", "FROM stg"),
            _sql("view_duplicate_pk", "duplicate_pk_groups", "count(*) = 0", "count(*)", "FROM (SELECT event_id FROM stg GROUP BY 1 HAVING count(*) > 1)"),
            """SELECT 'view_freshness', 'WARN', true, 'hours_since_last_success', CAST(round((epoch_us(TIMESTAMP '2024-01-31 00:00:00')
              - epoch_us(last_success_at)) / 3600000000.0, 1) AS VARCHAR) FROM state_new WHERE target_table = 'view'""",
            "SELECT 'view_schema', 'WARN', false, 'missing_columns', 'missing: note; expected 2, found 1'",
        ]
    ),
)
def table_checks(spark, d):
    spec = LoadSpec(
        "view", "raw_events", "view", ("event_id",), field_mappings=(FieldMapping("a", "event_id"), FieldMapping("b", "note"))
    )
    return Q.table_checks(events_staging(spark, d), spec, state(spark, d), AS_OF)


@query(
    "source_freshness",
    """SELECT event_type, max_loaded_at, round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max_loaded_at)) / 3600000000.0, 4) AS age_hours,
      CASE WHEN epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max_loaded_at) > 48 * 3600000000 THEN 'error'
        WHEN epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max_loaded_at) > 24 * 3600000000 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT 'all' AS event_type, max(ts) AS max_loaded_at FROM events
      UNION ALL SELECT 'day old', max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-29 12:00:00'
      UNION ALL SELECT 'week old', max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-24 00:00:00')""",
)
def source_freshness(spark, d):
    events = table(spark, d, "events")
    out = None
    for label, before in (("all", None), ("day old", "2024-01-29 12:00:00"), ("week old", "2024-01-24 00:00:00")):
        rows = events.filter(F.col("ts") < clock(before)) if before else events
        part = Q.source_freshness(rows, "ts", AS_OF, 24, 48).withColumn("event_type", F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "null_column_integrity",
    """SELECT 'c_mktsegment' AS column_name, count(c_mktsegment) AS source_present, 'FAIL' AS status FROM customer
    UNION ALL SELECT 'unused', 0, 'PASS'""",
)
def null_column_integrity(spark, d):
    nothing = F.lit(None).cast("string")
    source = table(spark, d, "customer").withColumn("unused", nothing)
    return Q.null_column_integrity(source.withColumn("c_mktsegment", nothing), source)


@query(
    "load_stats",
    f"""WITH {DIRTY} SELECT count(*) AS total_raw, count(*) FILTER (id IS NULL OR id = '') AS pk_missing,
      count(*) FILTER (id <> '') AS mapped,
      count(*) FILTER (id <> '' AND ts <= TIMESTAMP '2024-01-15 00:00:00') AS watermark_skipped FROM dirty""",
)
def load_stats(spark, d):
    return Q.load_stats(dirty_events(spark, d), "id", "ts", "2024-01-15 00:00:00")
