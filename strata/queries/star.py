"""Calendar, facts, wide tables and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.merge import merge_upsert
from strata.plans import star as S
from strata.plans.calendar import date_spine, dim_date
from strata.queries.base import AS_OF, query, table
from strata.queries.inputs import NEW_KEY, dim_customer, dim_nation, stg_orders
from strata.session import work_dir


def _span(spark, d):
    """First and last day of the orders, so the calendar follows the data."""
    low, high = table(spark, d, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return low.date(), high.date()


_DAYS = """days AS (SELECT CAST(range AS DATE) AS date_day FROM range(
  (SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) + INTERVAL 1 DAY FROM orders), INTERVAL 1 DAY))"""
_DIM_DATE = f"""{_DAYS}, dim_date AS (
  SELECT md5(CAST(date_day AS VARCHAR)) AS date_sk, date_day,
    CAST(extract(year FROM date_day) AS INTEGER) AS year_number, CAST(extract(year FROM date_day) AS VARCHAR) AS year_text,
    CAST(extract(quarter FROM date_day) AS INTEGER) AS quarter_number,
    CAST(extract(year FROM date_day) AS VARCHAR) || '-Q' || CAST(extract(quarter FROM date_day) AS VARCHAR) AS year_quarter,
    CAST(extract(month FROM date_day) AS INTEGER) AS month_number, strftime(date_day, '%B') AS month_name, strftime(date_day, '%b') AS month_short,
    strftime(date_day, '%Y-%m') AS year_month, CAST(extract(week FROM date_day) AS INTEGER) AS week_number,
    CAST(extract(dow FROM date_day) AS INTEGER) AS day_of_week_number, strftime(date_day, '%A') AS day_of_week_name,
    strftime(date_day, '%a') AS day_of_week_short, CAST(extract(day FROM date_day) AS INTEGER) AS day_of_month,
    CAST(extract(doy FROM date_day) AS INTEGER) AS day_of_year, extract(dow FROM date_day) IN (0, 6) AS is_weekend,
    extract(dow FROM date_day) BETWEEN 1 AND 5 AS is_weekday, date_day = DATE '2000-02-29' AS is_today,
    date_day = DATE '2000-02-28' AS is_yesterday, CAST(date_trunc('week', date_day) AS DATE) AS week_start_date,
    CAST(date_trunc('week', date_day) + INTERVAL 6 DAY AS DATE) AS week_end_date,
    CAST(date_trunc('month', date_day) AS DATE) AS month_start_date,
    CAST(date_trunc('month', date_day) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS month_end_date,
    CAST(date_trunc('quarter', date_day) AS DATE) AS quarter_start_date,
    CAST(date_trunc('quarter', date_day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
    CAST(date_trunc('year', date_day) AS DATE) AS year_start_date,
    CAST(date_trunc('year', date_day) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end_date
  FROM days)"""
_FACT = """stg AS (
  SELECT md5(CAST(o_orderkey AS VARCHAR)) AS order_sk, md5(CAST(o_custkey AS VARCHAR)) AS customer_sk,
    CAST(o_orderkey AS VARCHAR) AS order_id, lower(trim(o_orderstatus)) AS order_status,
    CAST(o_totalprice AS DECIMAL(18,2)) AS order_amount, o_orderdate AS created_at, o_orderdate AS updated_at FROM orders),
fct AS (SELECT order_sk, date_sk, customer_sk, order_id, order_status, order_amount, created_at, updated_at
  FROM stg LEFT JOIN dim_date ON CAST(created_at AS DATE) = date_day)"""
_OBT = """dc AS (SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_sk, md5(CAST(c_nationkey AS VARCHAR)) AS nation_sk,
    CAST(c_custkey AS VARCHAR) AS customer_id, lower(trim(c_mktsegment)) AS customer_segment FROM customer),
dn AS (SELECT md5(CAST(n_nationkey AS VARCHAR)) AS nation_sk, n_name AS nation_name FROM nation),
obt AS (SELECT fct.*, date_day, year_month, quarter_number, year_number, is_weekend, dc.customer_id, dc.customer_segment,
    dc.nation_sk, dn.nation_name
  FROM fct LEFT JOIN dim_date USING (date_sk) LEFT JOIN dc USING (customer_sk) LEFT JOIN dn ON dc.nation_sk = dn.nation_sk)"""
_REPORT = """SELECT year_month, customer_segment, count(*) AS total_records, count(DISTINCT customer_id) AS unique_customer_count,
  CAST(sum(order_amount) AS DOUBLE) AS total_amount, min(date_day) AS period_start, max(date_day) AS period_end
FROM obt GROUP BY 1, 2"""


@query("date_spine", f"WITH {_DAYS} SELECT date_day FROM days")
def date_spine_(spark, d):
    first, last = _span(spark, d)
    return date_spine(spark, first, last=last)


def _calendar(spark, d, **options):
    first, last = _span(spark, d)
    return dim_date(spark, "2000-02-29", first, last=last, **options)


@query("dim_date", f"WITH {_DIM_DATE} SELECT * FROM dim_date")
def dim_date_(spark, d):
    return _calendar(spark, d)


@query(
    "dim_date_fiscal",
    f"""WITH {_DIM_DATE} SELECT date_day, CASE WHEN month_number >= 2 THEN year_number ELSE year_number - 1 END AS fiscal_year,
      CASE WHEN month_number >= 2 THEN month_number - 1 ELSE month_number + 11 END AS fiscal_month_number FROM dim_date""",
)
def dim_date_fiscal(spark, d):
    return _calendar(spark, d, fiscal_start_month=2).select("date_day", "fiscal_year", "fiscal_month_number")


@query(
    "fct_join_date",
    f"WITH {_DIM_DATE} SELECT event_id, event_type, ts, md5(CAST(date_day AS VARCHAR)) AS date_sk FROM ("
    "SELECT event_id, event_type, ts, CASE WHEN CAST(ts AS DATE) < DATE '2024-01-20' THEN CAST(ts AS DATE) END AS date_day FROM events)",
)
def fct_join_date(spark, d):
    # The calendar ends on 2024-01-20: later events find no day and keep a NULL key.
    events = table(spark, d, "events").select("event_id", "event_type", "ts")
    return S.join_date(events, dim_date(spark, AS_OF, "2023-12-01", "2024-01-20"), "ts")


_FACT_COLUMNS = ["order_sk", "date_sk", "customer_sk", "order_id", "order_status", "order_amount", "created_at", "updated_at"]


def _fact(spark, d, calendar):
    return S.fct_build(stg_orders(spark, d), calendar, "created_at", _FACT_COLUMNS)


@query(
    "fct_build",
    f"""WITH {_DIM_DATE}, {_FACT} SELECT order_sk, date_sk, customer_sk, order_id, order_status,
      CAST(order_amount AS DOUBLE) AS order_amount FROM fct WHERE updated_at >= TIMESTAMP '2000-01-01 00:00:00' - INTERVAL 3 DAY""",
)
def fct_build(spark, d):
    fact = S.fct_build(
        stg_orders(spark, d),
        _calendar(spark, d),
        "created_at",
        _FACT_COLUMNS[:6],
        "updated_at",
        dt.datetime(2000, 1, 1),
    )
    return fact.withColumn("order_amount", F.col("order_amount").cast("double"))


def _wide(spark, d, **options):
    customer, calendar = dim_customer(spark, d), _calendar(spark, d)
    return S.obt_build(
        _fact(spark, d, calendar),
        calendar,
        ["date_day", "year_month", "quarter_number", "year_number", "is_weekend"],
        [
            (customer, "customer_sk", ["customer_id", "customer_segment", "nation_sk"]),
            (dim_nation(spark, d), "nation_sk", ["nation_name"]),
        ],
        **options,
    )


_OBT_COLUMNS = "date_day, year_month, quarter_number, year_number, is_weekend, customer_id, customer_segment, nation_name, order_id, order_status, created_at, updated_at"


@query("obt_prejoin", f"WITH {_DIM_DATE}, {_FACT}, {_OBT} SELECT {_OBT_COLUMNS} FROM obt")
def obt_prejoin(spark, d):
    return _wide(spark, d).select(*_OBT_COLUMNS.split(", "))


@query(
    "obt_build",
    f"WITH {_DIM_DATE}, {_FACT}, {_OBT} SELECT {_OBT_COLUMNS} FROM obt WHERE date_day >= DATE '2001-08-01' - 30",
)
def obt_build(spark, d):
    return _wide(spark, d, as_of="2001-08-01", recent_days=30).select(*_OBT_COLUMNS.split(", "))


def _metrics():
    return {
        "unique_customer_count": F.count_distinct("customer_id"),
        "total_amount": F.sum("order_amount").cast("double"),
    }


@query("report_rollup", f"WITH {_DIM_DATE}, {_FACT}, {_OBT} {_REPORT}")
def report_rollup(spark, d):
    return S.report_rollup(_wide(spark, d), ["year_month", "customer_segment"], _metrics())


@query(
    "report_build",
    f"""WITH {_DIM_DATE}, {_FACT}, {_OBT} SELECT year_month, nation_name, count(*) AS total_records,
      CAST(sum(order_amount) AS DOUBLE) AS total_amount, min(date_day) AS period_start, max(date_day) AS period_end
    FROM obt GROUP BY 1, 2""",
)
def report_build(spark, d):
    contract = {
        "year_month": "string",
        "nation_name": "string",
        "total_records": "bigint",
        "total_amount": "double",
        "period_start": "date",
        "period_end": "date",
    }
    amount = {"total_amount": F.sum("order_amount").cast("double")}
    return S.report_build(_wide(spark, d), ["year_month", "nation_name"], amount, contract)


@query(
    "report_incremental",
    """WITH late AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ts - INTERVAL 2 DAY ELSE ts END AS ts, user_id, event_type, value + 1 AS value
        FROM events WHERE ts >= TIMESTAMP '2024-01-25 00:00:00'),
      merged AS (SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00'
        UNION ALL SELECT * FROM late UNION ALL SELECT event_id + 1000000000, ts, user_id + 1, event_type, value FROM late WHERE event_id % 5 = 0)
    SELECT CAST(ts AS DATE) AS date_day, event_type, count(*) AS total_records, count(DISTINCT user_id) AS users, round(sum(value), 6) AS amount,
      min(CAST(ts AS DATE)) AS period_start, max(CAST(ts AS DATE)) AS period_end FROM merged GROUP BY 1, 2""",
)
def report_incremental(spark, d):
    """A report kept up after late updates that change, add and move rows between days, from those days alone."""
    by, metrics = ["date_day", "event_type"], {"users": F.count_distinct("user_id"), "amount": F.sum("value")}
    day, i = F.col("ts").cast("date"), F.col("event_id")
    rows = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    moved = F.when(i % 3 == 0, F.col("ts") - F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts"))
    late = rows.filter(F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")).withColumns({"ts": moved, "value": F.col("value") + 1})
    added = late.filter(i % 5 == 0).withColumns({"event_id": i + NEW_KEY, "user_id": F.col("user_id") + 1})
    before, batch = rows.withColumn("date_day", day), late.unionByName(added).withColumn("date_day", day)
    path = work_dir(spark, "wide")
    merge_upsert(before, batch, "event_id", "ts").write.partitionBy("date_day").parquet(path)
    periods = S.touched_periods(before, batch, "event_id", "date_day")
    out = S.report_incremental(S.report_rollup(before, by, metrics), spark.read.parquet(path), periods, by, metrics, "date_day")
    return out.withColumn("amount", F.round("amount", 6))
