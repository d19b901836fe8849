"""Profiles of a table and of a load run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.time import clock, hours_between
from strata.operators.aggregates import TOP_VALUES, is_empty
from strata.operators.align import find_column
from strata.operators.keysets import smallest_keys
from strata.specs import key_list

CELL_WIDTH = 40


def sample_rows(df: DataFrame, n: int = 5, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """``n`` rows as text, long cells cut to 40 characters and ``...``."""
    rows = df.orderBy(*key_list(order_by)).limit(n) if order_by else df.limit(n)
    cells = []
    for c in df.columns:
        text = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        cut = F.concat(F.substring(text, 1, CELL_WIDTH), F.lit("..."))
        cells.append(F.when(F.length(text) > CELL_WIDTH, cut).otherwise(text).alias(c))
    return rows.select(*cells)


def sample_markdown(df: DataFrame, n: int = 5, order_by: str | Sequence[str] | None = None) -> str:
    """The sample as a markdown table; at most ``n`` rows reach the driver."""
    rows = sample_rows(df, n, order_by).collect()
    if not rows:
        return "No data"
    lines = [df.columns, ["---"] * len(df.columns), *rows]
    return "".join("| " + " | ".join(cells) + " |\n" for cells in lines)


def run_metadata(
    df: DataFrame,
    keys_missing: int,
    row_count_before: int,
    watermark_before: str | None,
    incremental_column: str | None,
    as_of,
    last_run_at=None,
) -> DataFrame:
    """What one run did, as one row: counts, watermark before and after, value range, idle hours."""
    n = F.count("*")
    columns = {
        "row_count": F.lit(row_count_before).cast("bigint") + n,
        "row_count_delta": n,
        "records_processed": n,
        "errors": F.lit(keys_missing).cast("bigint"),
        "raw_records_fetched": n + keys_missing,
        "watermark_before": F.lit(watermark_before or "none"),
    }
    if incremental_column:
        low, high = (f(incremental_column).cast("string") for f in (F.min, F.max))
        columns["watermark_after"] = F.coalesce(high, F.lit(watermark_before or "none"))
        columns["date_range_min"], columns["date_range_max"] = low, high
    else:
        columns["watermark_after"] = F.lit(watermark_before or "none")
    if last_run_at is not None:
        columns["hours_since_last_run"] = F.round(hours_between(clock(as_of), clock(last_run_at)), 1)
    return df.agg(*[c.alias(name) for name, c in columns.items()])


@dataclass(frozen=True)
class Counted:
    """An analyzer that counts the rows of a table by a label; all of a profile's share one scan and one grouping."""

    label: Callable[[DataFrame, str], Column]
    listed: bool  # whether labels are listed with their counts, or are NULL_LABEL and PRESENT_LABEL
    key: str | None = None  # what the list is called, the column's distribution unless given


NULL_LABEL, PRESENT_LABEL = "null", "present"


def _emptiness(df: DataFrame, column: str) -> Column:
    return F.when(is_empty(df, column), NULL_LABEL).otherwise(PRESENT_LABEL)


def _shown(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("NULL"))


# Analyzers a profile spec may name. Others than these turn a table and a column into (metadata_key, metadata_value).
ANALYZERS: dict[str, Counted | Callable[[DataFrame, str], DataFrame]] = {
    "null_count": Counted(_emptiness, False),
    "value_counts": Counted(_shown, True),
    "row_count_by_event_type": Counted(_shown, True, "row_count_by_event_type"),
}


def label_counts(df: DataFrame, entries: Sequence[tuple[Counted, str]]) -> DataFrame:
    """Rows per entry and label (entry, label, n): one scan of the columns, one grouping that combines before rows move."""
    labels = F.array(*[c.label(df, column) for c, column in entries])
    return df.select(F.posexplode(labels).alias("entry", "label")).groupBy("entry", "label").agg(F.count("*").alias("n"))


def _counted_metadata(df: DataFrame, entries: Sequence[tuple[Counted, str]]) -> DataFrame:
    spark, counts = df.sparkSession, label_counts(df, entries)
    # Of each entry the most frequent labels, equal counts in order of label.
    place = F.row_number().over(Window.partitionBy("entry").orderBy(F.desc("n"), "label"))
    top = counts.withColumn("place", place).filter(F.col("place") <= TOP_VALUES)
    ranked = F.transform(F.sort_array(F.collect_list(F.struct("place", "label", "n"))), lambda r: F.concat(r["label"], F.lit(": "), r["n"]))

    def rows_with(label: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("label") == label, F.col("n"))), F.lit(0)).cast("string")

    found = top.groupBy("entry").agg(
        F.array_join(ranked, ", ").alias("list"), rows_with(NULL_LABEL).alias("null"), rows_with(PRESENT_LABEL).alias("present")
    )
    wanted = []
    for i, (c, column) in enumerate(entries):
        if c.listed:
            wanted.append((i, "list", c.key or f"{column}_distribution", ""))
        else:
            wanted += [(i, part, f"{column}_{part}", "0") for part in ("null", "present")]
    names = spark.createDataFrame(wanted, "entry int, part string, metadata_key string, none string")
    values = found.unpivot("entry", ["list", "null", "present"], "part", "value")
    return F.broadcast(names).join(values, ["entry", "part"], "left").select("metadata_key", F.coalesce("value", "none").alias("metadata_value"))


def custom_metadata(df: DataFrame, profile: Sequence[Mapping[str, str]]) -> DataFrame:
    """Declared profile of a table in long form; all built-in entries take one scan together."""
    chosen = [(ANALYZERS[p["type"]], p.get("column", "event_type")) for p in profile]
    if not chosen:
        raise ValueError("an empty profile has no result")
    counted = [(a, c) for a, c in chosen if isinstance(a, Counted)]
    parts = ([_counted_metadata(df, counted)] if counted else []) + [a(df, c) for a, c in chosen if not isinstance(a, Counted)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Names that usually hold a unique key.
KNOWN_KEYS = ("id", "uuid", "_id", "account_id")


def candidate_keys(
    df: DataFrame,
    known: Sequence[str] = KNOWN_KEYS,
    columns: Sequence[str] | None = None,
    max_columns: int | None = None,
) -> DataFrame:
    """Smallest column sets that identify every row: (key_columns, n_columns, n_rows).

    A unique well-known name ends the search, and so do rows that repeat in all columns. Otherwise all keys of the fewest columns are
    reported, see :func:`strata.operators.keysets.smallest_keys`; ``max_columns`` ends the search earlier. A key part may not be NULL
    anywhere.
    """
    spark = df.sparkSession
    names = list(columns or df.columns)
    n, *present = df.agg(F.count("*"), *[F.count(F.col(f"`{c}`")) for c in names]).first()
    filled = [c for c, k in zip(names, present) if k == n]

    def unique(c: str) -> bool:
        return df.groupBy(F.col(f"`{c}`")).count().filter("count > 1").isEmpty()

    usual = [find_column(k, filled) for k in known]
    found = next(([(c,)] for c in usual if c and unique(c)), []) if n else []
    found = found or smallest_keys(df, filled, n, max_columns)
    rows = [(",".join(s), len(s), n) for s in found]
    return spark.createDataFrame(rows, "key_columns string, n_columns int, n_rows bigint")
