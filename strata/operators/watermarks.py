"""The load-state table: one row per (layer, schema, table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.time import clock
from strata.operators.align import align_by_name
from strata.operators.dedup import latest_state

STATE_KEY = ("layer", "target_schema", "target_table")
SUCCESS = ("success", "no_new_data")
ERROR_LENGTH = 500

STATE_SCHEMA = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("target_schema", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("source_object", T.StringType()),
        T.StructField("watermark_column", T.StringType()),
        T.StructField("watermark_value", T.StringType()),
        T.StructField("watermark_type", T.StringType()),
        T.StructField("last_run_at", T.TimestampNTZType()),
        T.StructField("last_success_at", T.TimestampNTZType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

# Column defaults of a new state row.
STATE_DEFAULTS = {"watermark_type": "timestamp", "rows_processed": 0, "status": "pending"}


def watermark_get(state: DataFrame) -> DataFrame:
    """Newest watermark value of every table."""
    return latest_state(state, STATE_KEY).select(*STATE_KEY, "watermark_value", "last_run_at", "status")


def _with_defaults(rows: DataFrame, run_ts) -> DataFrame:
    full = align_by_name(rows, STATE_SCHEMA)
    fills = {c: F.coalesce(F.col(c), F.lit(v).cast(STATE_SCHEMA[c].dataType)) for c, v in STATE_DEFAULTS.items()}
    return full.withColumns({**fills, "created_at": F.coalesce("created_at", clock(run_ts))})


def watermark_update(state: DataFrame, updates: DataFrame, run_ts) -> DataFrame:
    """Replace the rows of the updated tables.

    ``updates`` has the key, ``watermark_value``, ``rows_processed`` and optionally ``status``.
    Everything else of a replaced row starts anew, as after a delete and an insert.
    """
    stamp = clock(run_ts)
    status = F.coalesce("status", F.lit("success")) if "status" in updates.columns else F.lit("success")
    rows = _with_defaults(
        updates.withColumns({"status": status, "last_run_at": stamp, "last_success_at": stamp, "updated_at": stamp}),
        run_ts,
    )
    others = align_by_name(state, STATE_SCHEMA).join(updates.select(*STATE_KEY), list(STATE_KEY), "left_anti")
    return others.select(*STATE_SCHEMA.names).unionByName(rows)


def watermark_mark_started(state: DataFrame, started: DataFrame, run_ts) -> DataFrame:
    """Touch ``last_run_at`` of tables that already have a row; unknown tables get none."""
    flagged = _flag(state, started)
    hit, stamp = F.col("_hit").isNotNull(), clock(run_ts)
    touched = {c: F.when(hit, stamp).otherwise(F.col(c)) for c in ("last_run_at", "updated_at")}
    return flagged.withColumns(touched).select(*STATE_SCHEMA.names)


def watermark_set_status(state: DataFrame, statuses: DataFrame, run_ts) -> DataFrame:
    """Upsert status and error text; ``last_success_at`` moves on success only.

    ``statuses`` has the key, ``status`` and ``error_message``.
    """
    stamp = clock(run_ts)
    new = statuses.select(
        *STATE_KEY,
        F.col("status").alias("_status"),
        F.substring("error_message", 1, ERROR_LENGTH).alias("_error"),
    )
    won = F.col("_status").isin(*SUCCESS)
    flagged = _flag(state, new)
    hit = F.col("_hit").isNotNull()

    def set_to(value: Column, column: str) -> Column:
        return F.when(hit, value).otherwise(F.col(column))

    updated = flagged.withColumns(
        {
            "last_success_at": F.when(hit & won, stamp).otherwise(F.col("last_success_at")),
            "status": set_to(F.col("_status"), "status"),
            "error_message": set_to(F.col("_error"), "error_message"),
            "last_run_at": set_to(stamp, "last_run_at"),
            "updated_at": set_to(stamp, "updated_at"),
        }
    ).select(*STATE_SCHEMA.names)
    first = new.join(state.select(*STATE_KEY), list(STATE_KEY), "left_anti").select(
        *STATE_KEY,
        F.col("_status").alias("status"),
        F.col("_error").alias("error_message"),
        stamp.alias("last_run_at"),
        F.when(won, stamp).alias("last_success_at"),
        stamp.alias("updated_at"),
    )
    return updated.unionByName(_with_defaults(first, run_ts))


def _flag(state: DataFrame, tables: DataFrame) -> DataFrame:
    """State rows with ``_hit`` set where the table is named in ``tables``."""
    named = tables.withColumn("_hit", F.lit(True))
    return align_by_name(state, STATE_SCHEMA).join(named, list(STATE_KEY), "left")


def state_rows(df: DataFrame, layer: str, schema: str, table: Column, columns: Sequence[Column]) -> DataFrame:
    """State-shaped rows from any table of observations."""
    return df.select(
        F.lit(layer).alias("layer"), F.lit(schema).alias("target_schema"), table.alias("target_table"), *columns
    )
