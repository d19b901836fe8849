"""Projection, scalar expressions and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import clean_string, json_dump, safe_id, surrogate_key, to_str, warehouse_ts, yes_flag
from strata.functions.text import json_value
from strata.operators import mapping as M
from strata.queries.base import AS_OF, query, table
from strata.queries.inputs import DIRTY, STATE_ALL, dirty_events, raw_events, state
from strata.specs import FieldMapping


@query(
    "map_nested",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id AS user,
      CAST(NULL AS VARCHAR) AS missing_step, CAST(NULL AS VARCHAR) AS step_into_value
    FROM events""",
)
def map_nested(spark, d):
    raw = raw_events(spark, d)
    return raw.select(
        F.col("id").cast("bigint").alias("event_id"),
        M.nested(raw.schema, "payload.props.k").alias("k"),
        M.nested(raw.schema, "payload.user").alias("user"),
        M.nested(raw.schema, "payload.nothing.here").alias("missing_step"),
        M.nested(raw.schema, "payload.user.name").alias("step_into_value"),
    )


@query(
    "map_fields",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
      CAST(user_id AS VARCHAR) AS user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
      TIMESTAMP '2024-01-31 00:00:00' AS inserted_at, TIMESTAMP '2024-01-31 00:00:00' AS updated_at
    FROM events""",
)
def map_fields(spark, d):
    mappings = [
        FieldMapping("id", "event_id"),
        FieldMapping("at", "created_at", "warehouse_ts"),
        FieldMapping("payload.user", "user_id", "to_str"),
        FieldMapping("payload.props.k", "k"),
    ]
    return M.map_fields(raw_events(spark, d), mappings, AS_OF, ("inserted_at", "updated_at"))


@query(
    "to_str",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS user_text, CAST(NULLIF(user_id, 7) AS VARCHAR) AS maybe_null FROM events",
)
def to_str_(spark, d):
    return table(spark, d, "events").select(
        "event_id", to_str("user_id").alias("user_text"), to_str(F.nullif("user_id", F.lit(7))).alias("maybe_null")
    )


@query(
    "warehouse_ts",
    """SELECT event_id, CASE event_id % 7
        WHEN 5 THEN '1970-01-01 00:00:00'
        WHEN 4 THEN strftime(ts, '%Y-%m-%d') || ' 00:00:00'
        WHEN 6 THEN strftime(ts, '%Y-%m-%d %H:%M')
        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS loaded_text
    FROM events""",
)
def warehouse_ts_(spark, d):
    i = F.col("event_id") % 7
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(i == 0, F.concat(iso, F.lit("Z")))
        .when(i == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(i == 2, F.concat(F.lit("  "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ")))
        .when(i == 3, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-0500")))
        .when(i == 4, F.date_format("ts", "yyyy-MM-dd"))
        .when(i == 5, F.lit(" "))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    )
    return table(spark, d, "events").select("event_id", warehouse_ts(text).alias("loaded_text"))


@query(
    "json_dump",
    """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"user":' || CAST(user_id AS VARCHAR) || '}' AS object_json,
      '"' || event_type || '"' AS text_json, CAST(user_id AS VARCHAR) AS number_json, CAST(NULL AS VARCHAR) AS null_json
    FROM events""",
)
def json_dump_(spark, d):
    raw = raw_events(spark, d)
    return raw.select(
        F.col("id").cast("bigint").alias("event_id"),
        json_dump(F.struct(F.col("payload.props.k").alias("k"), F.col("payload.user").alias("user"))).alias("object_json"),
        json_dump("event_type").alias("text_json"),
        json_dump("user_id").alias("number_json"),
        json_dump(F.lit(None).cast("string")).alias("null_json"),
    )


@query(
    "auto_timestamps",
    """SELECT event_id, TIMESTAMP '2024-01-31 00:00:00' AS inserted_at, TIMESTAMP '2024-01-31 00:00:00' AS updated_at
    FROM events""",
)
def auto_timestamps(spark, d):
    return M.auto_timestamps(table(spark, d, "events").select("event_id"), AS_OF)


@query("filter_missing_pk", f"WITH {DIRTY} SELECT id, created, ts FROM dirty WHERE id IS NOT NULL AND id <> ''")
def filter_missing_pk(spark, d):
    return M.filter_missing_pk(dirty_events(spark, d), "id").select("id", "created", "ts")


@query("filter_watermark", "SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'")
def filter_watermark(spark, d):
    rows = table(spark, d, "events").select("event_id", "ts", "event_type")
    return M.filter_watermark(rows, "ts", "2024-01-20 12:00:00", keep_null=False)


@query(
    "date_range",
    f"""WITH {STATE_ALL}
    SELECT target_table, coalesce(CAST(substr(CASE WHEN status <> 'failed' THEN watermark_value END, 1, 10) AS DATE),
        DATE '2024-01-31' - 90) AS from_date, DATE '2024-01-31' AS to_date
    FROM state_new""",
)
def date_range(spark, d):
    known = state(spark, d).withColumn(
        "watermark_value", F.when(F.col("status") != "failed", F.col("watermark_value"))
    )
    return M.date_range(known, AS_OF).select("target_table", "from_date", "to_date")


@query("clean_string", "SELECT page_id, lower(trim(url)) AS url, lower(trim('  ' || html || ' ')) AS body FROM pages")
def clean_string_(spark, d):
    padded = F.concat(F.lit("  "), F.col("html"), F.lit(" "))
    return table(spark, d, "pages").select("page_id", clean_string("url").alias("url"), clean_string(padded).alias("body"))


@query(
    "safe_cast_id",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, c_name FROM orders
    JOIN customer ON CAST(o_custkey AS VARCHAR) = CAST(c_custkey AS VARCHAR)""",
)
def safe_cast_id(spark, d):
    orders = table(spark, d, "orders").select(safe_id("o_orderkey").alias("order_id"), safe_id("o_custkey").alias("customer_id"))
    customers = table(spark, d, "customer").select(safe_id("c_custkey").alias("customer_id"), "c_name")
    return orders.join(customers, "customer_id").select("order_id", "c_name")


@query("limit_recent", "SELECT event_id, ts FROM events WHERE ts >= DATE '2024-01-31' - 10")
def limit_recent(spark, d):
    return M.limit_recent(table(spark, d, "events").select("event_id", "ts"), "ts", AS_OF, days=10)


@query(
    "surrogate_key",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
        || coalesce(CAST(NULLIF(l_returnflag, 'N') AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS line_sk
    FROM lineitem""",
)
def surrogate_key_(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        surrogate_key("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N"))).alias("line_sk"),
    )


@query(
    "stage_clean",
    """SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_sk, CAST(c_custkey AS VARCHAR) AS customer_id,
      lower(trim(c_name)) AS customer_name, lower(trim(c_mktsegment)) AS customer_segment,
      CASE WHEN c_acctbal >= 0 THEN true ELSE false END AS is_active
    FROM customer WHERE c_custkey IS NOT NULL AND c_acctbal > -500""",
)
def stage_clean(spark, d):
    return M.stage_clean(
        table(spark, d, "customer"),
        {
            "customer_sk": surrogate_key("c_custkey"),
            "customer_id": safe_id("c_custkey"),
            "customer_name": clean_string("c_name"),
            "customer_segment": clean_string("c_mktsegment"),
            "is_active": yes_flag(F.when(F.col("c_acctbal") >= 0, "Y").otherwise("N")),
        },
        keep=F.col("c_custkey").isNotNull() & (F.col("c_acctbal") > -500),
    )


@query(
    "rename_glossary",
    """SELECT c_custkey AS account_id, c_name AS contact_name, c_mktsegment AS customer_segment, c_acctbal AS ltv,
      c_nationkey FROM customer""",
)
def rename_glossary(spark, d):
    aliased = table(spark, d, "customer").withColumnsRenamed(
        {"c_custkey": "acct_id", "c_name": "full_name", "c_mktsegment": "segment", "c_acctbal": "clv"}
    )
    return M.rename_glossary(aliased)


@query("drop_etl_columns", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def drop_etl_columns(spark, d):
    synced = table(spark, d, "nation").withColumns(
        {"_airbyte_raw_id": F.md5("n_name"), "_airbyte_extracted_at": F.lit(AS_OF), "_AIRBYTE_META": F.lit("{}")}
    )
    return M.drop_etl_columns(synced)


@query(
    "null_zero_dates",
    f"""WITH {DIRTY} SELECT ts, id, CASE WHEN created NOT IN ('0000-00-00', '0000-00-00 00:00:00', '') THEN created END AS created,
      event_type FROM dirty""",
)
def null_zero_dates(spark, d):
    return M.null_zero_dates(dirty_events(spark, d), ["created"]).select("ts", "id", "created", "event_type")


@query(
    "map_types",
    """SELECT event_id, try_cast(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS n,
      ts AS at, CAST(ts AS DATE) AS on_day, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS flag,
      CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def map_types(spark, d):
    text = table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("n"),
        F.col("ts").cast("string").alias("at"),
        F.date_format("ts", "yyyy-MM-dd").alias("on_day"),
        F.when(F.col("event_id") % 2 == 0, "true").otherwise("0").alias("flag"),
        "props",
    )
    typed = M.map_types(
        text, {"n": "integer", "at": "datetime", "on_day": "date", "flag": "tinyint(1)", "props": "json"}
    )
    return typed.withColumn("k", F.variant_get("props", "$.k", "bigint")).drop("props")


@query(
    "enrich_events",
    """SELECT page_id, nullif(regexp_extract(url, '[0-9]+'), '') AS page_uuid,
      CASE WHEN url LIKE '%/fr/%' THEN 'french' WHEN url LIKE '%/en/%' THEN 'english' ELSE 'other' END AS url_type,
      split_part(url, '/', 3) AS url_host,
      CASE WHEN page_id % 4 = 0 THEN 'direct' WHEN page_id % 4 = 1 THEN 'internal' ELSE 'external' END AS referer_type,
      CAST(CASE WHEN page_id % 3 = 0 THEN NULL ELSE page_id % 90 + 0.25 END AS DECIMAL(10,6)) AS page_lat,
      CAST(-(page_id % 180) AS DECIMAL(10,6)) AS page_long,
      CAST(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * page_id AS DATE) AS event_date
    FROM pages""",
)
def enrich_events(spark, d):
    i = F.col("page_id")
    host = F.split_part("url", F.lit("/"), F.lit(3))
    views = table(spark, d, "pages").select(
        "page_id",
        "url",
        F.when(i % 4 == 1, F.concat(F.lit("https://"), host, F.lit("/start"))).when(i % 4 != 0, "https://search.example/x").alias("referer"),
        F.concat_ws(
            ",", F.when(i % 3 == 0, "n/a").otherwise(F.concat(i % 90, F.lit(".25"))), F.concat(F.lit(" -"), i % 180)
        ).alias("lat_long"),
        F.timestamp_add("HOUR", i.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("event_start"),
    )
    wide = M.enrich_page_views(
        views, "url", "[0-9]+", [("%/fr/%", "french"), ("%/en/%", "english")], "referer", "lat_long", "event_start"
    )
    return wide.drop("url", "referer", "lat_long", "event_start")


@query(
    "variant_path",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
      CAST(NULL AS VARCHAR) AS missing FROM events""",
)
def variant_path(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        json_value("props", "k", "bigint").alias("k"),
        json_value("props", "k", "string").alias("k_text"),
        json_value("props", "other", "string").alias("missing"),
    )


@query(
    "order_columns",
    """SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_sk, md5(CAST(c_nationkey AS VARCHAR)) AS nation_sk,
      CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_acctbal AS balance_amount,
      TIMESTAMP '2024-01-31 00:00:00' AS created_at FROM customer""",
)
def order_columns(spark, d):
    mixed = table(spark, d, "customer").select(
        F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"),
        F.col("c_acctbal").alias("balance_amount"),
        F.col("c_name").alias("customer_name"),
        safe_id("c_custkey").alias("customer_id"),
        surrogate_key("c_nationkey").alias("nation_sk"),
        surrogate_key("c_custkey").alias("customer_sk"),
    )
    return M.order_columns(mixed, "customer_sk")


@query(
    "json_date_parts",
    """SELECT event_id, CAST(ts AS DATE) AS created_day, date_trunc('second', ts) AS created_at FROM events""",
)
def json_date_parts(spark, d):
    text = warehouse_ts(F.col("at"))
    return raw_events(spark, d).select(
        F.col("id").cast("bigint").alias("event_id"),
        F.to_date(text).alias("created_day"),
        text.cast("timestamp_ntz").alias("created_at"),
    )
