"""Slowly changing history."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.time import clock
from strata.operators import history as H
from strata.plans.snapshots import extend_history
from strata.queries.base import AS_OF, ORACLES, query, table
from strata.queries.inputs import CUSTOMERS, ORDER_HISTORY, customer_v1, customer_v2, order_log
from strata.session import staged, work_dir

_ROWS = "c_custkey, c_name, c_mktsegment, c_acctbal, updated_at, valid_from, valid_to"


def _snapshot_sql(changed: str, opened: str, hard_deletes: bool, first: str) -> str:
    gone = "TIMESTAMP '2024-01-31 00:00:00'" if hard_deletes else "NULL"
    return f"""WITH {CUSTOMERS}, j AS (
      SELECT v1.c_custkey AS ok, v2.c_custkey AS nk, v2.*, {opened} AS opened, coalesce({changed}, false) AS changed
      FROM v1 FULL OUTER JOIN v2 ON v1.c_custkey = v2.c_custkey)
    SELECT v1.*, {first} AS valid_from, CASE WHEN j.nk IS NULL THEN {gone} WHEN j.changed THEN j.opened END AS valid_to
    FROM v1 JOIN j ON v1.c_custkey = j.ok
    UNION ALL
    SELECT c_custkey, c_name, c_mktsegment, c_acctbal, updated_at, opened, NULL FROM j
    WHERE nk IS NOT NULL AND (ok IS NULL OR changed)"""


@query(
    "snapshot_timestamp",
    _snapshot_sql("v2.updated_at > v1.updated_at", "v2.updated_at", False, "TIMESTAMP '2024-01-10 00:00:00'"),
)
def snapshot_timestamp(spark, d):
    first = H.snapshot_timestamp(None, customer_v1(spark, d), "c_custkey", "updated_at", "2024-01-11 00:00:00")
    return H.snapshot_timestamp(first, customer_v2(spark, d), "c_custkey", "updated_at", AS_OF)


@query("snapshot_append", ORACLES["snapshot_timestamp"])
def snapshot_append(spark, d):
    folder = work_dir(spark, "history")
    extend_history(spark, folder, customer_v1(spark, d), "c_custkey", "2024-01-11 00:00:00", updated_at="updated_at")
    return extend_history(spark, folder, customer_v2(spark, d), "c_custkey", AS_OF, updated_at="updated_at")


_CHECKED = "v1.c_mktsegment IS DISTINCT FROM v2.c_mktsegment"


@query(
    "snapshot_check",
    _snapshot_sql(_CHECKED, "TIMESTAMP '2024-01-31 00:00:00'", False, "TIMESTAMP '2024-01-11 00:00:00'"),
)
def snapshot_check(spark, d):
    checked = ["c_mktsegment"]
    first = H.snapshot_check(None, customer_v1(spark, d), "c_custkey", checked, "2024-01-11 00:00:00")
    return H.snapshot_check(first, customer_v2(spark, d), "c_custkey", checked, AS_OF)


@query(
    "snapshot_hard_delete",
    _snapshot_sql("v2.updated_at > v1.updated_at", "v2.updated_at", True, "TIMESTAMP '2024-01-10 00:00:00'"),
)
def snapshot_hard_delete(spark, d):
    first = H.snapshot_timestamp(None, customer_v1(spark, d), "c_custkey", "updated_at", "2024-01-11 00:00:00")
    return H.snapshot_timestamp(first, customer_v2(spark, d), "c_custkey", "updated_at", AS_OF, hard_deletes=True)


@query("bulk_history", f"WITH {ORDER_HISTORY} SELECT * FROM hist")
def bulk_history(spark, d):
    return H.bulk_history(order_log(spark, d), "o_custkey", "changed_at", ["o_orderkey"])


def _order_facts(spark, d):
    """Lineitems with the customer of their order."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).drop("o_orderkey")


_ASOF = f"""WITH {ORDER_HISTORY}, facts AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT f.*, h.o_orderstatus AS known_status, h.o_orderkey AS known_order FROM facts f LEFT JOIN hist h
  ON f.o_custkey = h.o_custkey AND f.l_shipdate >= h.valid_from AND f.l_shipdate < coalesce(h.valid_to, TIMESTAMP '9999-12-31 00:00:00')"""


@query("scd2_asof_join", _ASOF)
def scd2_asof_join(spark, d):
    # The facts come out of a join, which is not to run again for counting; hot keys are looked for once, for both steps.
    facts, log = staged(_order_facts(spark, d), "facts"), order_log(spark, d)
    slices = H.time_slices([(facts, "l_shipdate"), (log, "changed_at")], "o_custkey")
    known = H.bulk_history(log, "o_custkey", "changed_at", ["o_orderkey"], slices).select(
        "o_custkey",
        F.col("o_orderstatus").alias("known_status"),
        F.col("o_orderkey").alias("known_order"),
        "valid_from",
        "valid_to",
    )
    return H.asof_join(facts, known, "o_custkey", "l_shipdate", ["known_status", "known_order"], slices)


@query(
    "dim_scd1",
    f"""WITH {CUSTOMERS}, both_rows AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2)
    SELECT c_custkey, c_mktsegment, updated_at FROM (
      SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY updated_at DESC, c_name DESC NULLS LAST,
        c_mktsegment DESC NULLS LAST, c_acctbal DESC NULLS LAST) AS rn FROM both_rows) WHERE rn = 1""",
)
def dim_scd1(spark, d):
    rows = customer_v1(spark, d).unionByName(customer_v2(spark, d))
    return H.dim_scd1(rows, "c_custkey", ["c_custkey", "c_mktsegment", "updated_at"], "updated_at")


@query(
    "history_point_in_time",
    f"""WITH {ORDER_HISTORY} SELECT o_custkey, o_orderstatus, o_orderkey FROM hist
    WHERE valid_from <= TIMESTAMP '1998-06-01 00:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-06-01 00:00:00')""",
)
def history_point_in_time(spark, d):
    at = clock("1998-06-01 00:00:00")
    current = (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    return bulk_history(spark, d).filter(current).select("o_custkey", "o_orderstatus", "o_orderkey")
