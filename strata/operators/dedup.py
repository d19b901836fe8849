"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.specs import key_list


def sortable(field: T.StructField) -> Column:
    """A column as something with a total order: maps and variants through their JSON text."""
    c = F.col(f"`{field.name}`")
    return F.to_json(c) if isinstance(field.dataType, (T.MapType, T.VariantType)) else c


def latest_first(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str] | None) -> list[Column]:
    """Newest first, NULL last, and every other column as tie-break so that results repeat."""
    first = [order_by] if isinstance(order_by, str) else list(order_by or ())
    fixed = {c.lower() for c in (*keys, *first)}
    rest = [f for f in df.schema if f.name.lower() not in fixed]
    return [F.col(c).desc_nulls_last() for c in first] + [sortable(f).desc_nulls_last() for f in rest]


def top_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key.

    A row_number filter makes Spark keep only ``n`` rows per key in every map task before the
    shuffle, so a key that holds a large part of the table sends at most ``n`` rows per task.
    """
    window = Window.partitionBy(*key_list(keys)).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def dedup_latest(
    df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str] | None = None
) -> DataFrame:
    """Newest row per key by ``order_by``; without it the greatest row by all columns."""
    names = key_list(keys)
    order = latest_first(df, names, order_by)
    return top_per_key(df, names, order) if order else df.dropDuplicates(names)


def latest_state(state: DataFrame, keys: Sequence[str] = ("layer", "target_schema", "target_table")) -> DataFrame:
    """Newest state row of every table."""
    return dedup_latest(state, keys, "updated_at")
