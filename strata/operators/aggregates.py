"""Table and column statistics and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import sortable
from strata.specs import key_list

TOP_VALUES = 20


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows."""
    return df.agg(F.count("*").alias("row_count"))


def column_stats(df: DataFrame, exact: bool = True) -> DataFrame:
    """Name, type, NULL count and distinct count of every column.

    The exact counts group each column by itself, so a columnar scan reads every byte once, no row is copied, and
    repeated values meet before the shuffle. ``exact=False`` estimates all of them from sketches in one aggregation.
    """
    if exact:
        out = None
        for f in df.schema:
            values = df.groupBy(sortable(f).alias("v")).agg(F.count("*").alias("n"))
            part = values.agg(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_count"),
                F.count("v").alias("distinct_count"),
            )
            out = part if out is None else out.unionByName(part)
        return out
    stats = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            (F.count("*") - F.count(F.col(f"`{f.name}`"))).alias("null_count"),
            F.approx_count_distinct(sortable(f)).alias("distinct_count"),
        )
        for f in df.schema
    ]
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


def range_stats(df: DataFrame, column: str) -> DataFrame:
    """Smallest and greatest value of a column."""
    return df.agg(F.min(column).alias("date_range_min"), F.max(column).alias("date_range_max"))


def value_counts(df: DataFrame, column: str, top: int = TOP_VALUES) -> DataFrame:
    """The ``top`` most frequent values, NULL shown as text; equal counts in order of value."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("NULL")).alias("value")
    counts = df.groupBy(value).agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), "value").limit(top)


def is_empty(df: DataFrame, column: str) -> Column:
    """NULL or empty text."""
    c = F.col(column)
    return c.isNull() | (c == "") if isinstance(df.schema[column].dataType, T.StringType) else c.isNull()


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL-or-empty and present counts of several columns from one aggregation."""
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(is_empty(df, c)).alias("null_count"),
            F.count_if(~is_empty(df, c)).alias("present_count"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def dup_groups(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once and how often."""
    return df.groupBy(*key_list(keys)).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def entity_counts(df: DataFrame, entity: str, id_column: str, distinct_column: str) -> DataFrame:
    """Per entity: number of ids and number of distinct values."""
    return df.groupBy(entity).agg(
        F.count(id_column).alias("total_count"), F.count_distinct(distinct_column).alias("distinct_count")
    )


def pivot_metrics(
    df: DataFrame, keys: str | Sequence[str], column: str, values: Sequence, prefix: str = "", other: str | None = None
) -> DataFrame:
    """Row counts per key and value, one column per listed value: one aggregation, no second shuffle.

    ``other`` names a column for the rows with any other value, NULL included.
    """
    counts = [F.count_if(F.col(column) == v).alias(f"{prefix}{v}") for v in values]
    if other is not None:
        listed = F.coalesce(F.col(column).isin(*values), F.lit(False))
        counts.append(F.count_if(~listed).alias(f"{prefix}{other}"))
    return df.groupBy(*key_list(keys)).agg(*counts)


def unpivot_metrics(df: DataFrame, keys: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key and metric."""
    return df.unpivot(key_list(keys), list(columns), "metric", "value")
