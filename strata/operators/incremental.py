"""Which rows an incremental run reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.align import find_column
from strata.operators.mapping import filter_watermark
from strata.specs import key_list

LOOKBACK_DAYS = 3
DEV_DAYS = 30
SMALL_TABLE_ROWS = 10_000


def high_water(df: DataFrame, column: str):
    """Greatest value of a column as one driver-side scalar; None on an empty table.

    A scalar becomes a literal in the next filter, which the scan can push down. Times come as wall
    clock of the session, whatever the time zone of the driver.
    """
    top = F.max(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        top = top.cast("timestamp_ntz")
    return df.agg(top).first()[0]


def _days_before(high, days: int) -> Column:
    bound = F.lit(str(high)).cast("timestamp_ntz") if isinstance(high, (str, dt.datetime)) else F.lit(high)
    return bound - F.expr(f"INTERVAL {int(days)} DAYS")


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    """Greatest non-empty value, in the column's own type, plus the text form that is stored."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        c = F.when(c != "", c)
    top = df.agg(F.max(c).alias("max_value"))
    return top.select("max_value", F.col("max_value").cast("string").alias("watermark_value"))


def lookback(df: DataFrame, column: str, high, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows no older than ``days`` before the target's high-water mark; a first run reads everything."""
    if high is None:
        return df
    return df.filter(F.col(column) >= _days_before(high, days))


def window_predicate(
    column: str,
    as_of,
    backfill: tuple | None = None,
    target_high=None,
    lookback_days: int = LOOKBACK_DAYS,
    dev_days: int = DEV_DAYS,
) -> Column:
    """One predicate, chosen in this order: backfill range, lookback on an existing target, recent days."""
    c = F.col(column)
    if backfill is not None:
        start, end = (F.lit(str(b)).cast("timestamp_ntz") for b in backfill)
        return (c >= start) & (c < end)
    if target_high is not None:
        return c >= _days_before(target_high, lookback_days)
    return c >= F.date_sub(F.lit(str(as_of)).cast("date"), dev_days)


def incremental_window(df: DataFrame, column: str, as_of, **choice) -> DataFrame:
    """Filter by :func:`window_predicate`."""
    return df.filter(window_predicate(column, as_of, **choice))


def incremental_id(df: DataFrame, column: str, watermark: int | None) -> DataFrame:
    """Rows with a greater id than the watermark."""
    return filter_watermark(df, column, watermark, keep_null=False)


# Column names searched for, in order of preference.
UPDATED_COLUMNS = ("updated_at", "modified_at", "last_modified", "LastModifiedDate")
CREATED_COLUMNS = ("created_at", "inserted_at", "created_date", "CreatedDate")


def detect_strategy(df: DataFrame, primary_key: str | Sequence[str] | None = None) -> DataFrame:
    """One row naming the incremental strategy a table supports, with the confidence in it.

    The schema decides all cases but the last two, which also need the row count.
    """

    def has_time(name: str) -> str | None:
        found = find_column(name, df.columns)
        timed = (T.TimestampType, T.TimestampNTZType, T.DateType)
        return found if found and isinstance(df.schema[found].dataType, timed) else None

    rows = F.count("*")
    updated = next(filter(None, map(has_time, UPDATED_COLUMNS)), None)
    created = next(filter(None, map(has_time, CREATED_COLUMNS)), None)
    keys = key_list(primary_key) if primary_key else []
    numeric = len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, (T.IntegerType, T.LongType))

    if updated:
        choice = [F.lit("timestamp"), F.lit(updated), F.lit("updated"), F.lit("high")]
    elif created:
        choice = [F.lit("timestamp"), F.lit(created), F.lit("created"), F.lit("medium")]
    elif numeric:
        choice = [F.lit("incremental_id"), F.lit(keys[0]), F.lit("id"), F.lit("medium")]
    else:
        small = rows < SMALL_TABLE_ROWS
        choice = [
            F.when(small, "full_refresh").otherwise("needs_discussion"),
            F.lit(None).cast("string"),
            F.when(small, "full").otherwise("custom"),
            F.when(small, "high").otherwise("low"),
        ]
    names = ("strategy", "column_name", "column_kind", "confidence")
    return df.agg(*[c.alias(n) for c, n in zip(choice, names)], rows.alias("n_rows"))


def as_timestamp(value) -> dt.datetime:
    """A clock argument as a datetime."""
    return value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
