"""Facts, wide tables and reports over a star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.incremental import LOOKBACK_DAYS, lookback
from strata.operators.joins import left_lookup
from strata.operators.mapping import limit_recent
from strata.operators.quality import assert_contract
from strata.specs import key_list


def join_date(fact: DataFrame, calendar: DataFrame, created_at: str) -> DataFrame:
    """Add ``date_sk`` for the day of a timestamp; NULL outside the calendar."""
    dated = fact.withColumn("date_day", F.col(created_at).cast("date"))
    return left_lookup(dated, calendar, "date_day", ["date_sk"]).drop("date_day")


def fct_build(
    staging: DataFrame,
    calendar: DataFrame,
    created_at: str,
    columns: Sequence[str],
    updated_at: str | None = None,
    target_high=None,
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Fact model: late-data lookback, date key, declared columns in order."""
    rows = lookback(staging, updated_at, target_high, lookback_days) if updated_at else staging
    return join_date(rows, calendar, created_at).select(*columns)


def obt_build(
    fact: DataFrame,
    calendar: DataFrame,
    calendar_columns: Sequence[str],
    lookups: Sequence[tuple[DataFrame, str, Sequence[str]]] = (),
    as_of=None,
    recent_days: int | None = None,
) -> DataFrame:
    """Wide table at the grain of the fact: all dimensions joined, nothing aggregated.

    The date comes first, so a recent-days filter thins the fact before the other joins.
    ``lookups`` are (dimension, key, columns).
    """
    wide = left_lookup(fact, calendar, "date_sk", calendar_columns)
    if recent_days is not None:
        wide = limit_recent(wide, "date_day", as_of, recent_days)
    for dim, key, columns in lookups:
        # Hot keys are looked for in the fact alone where it has the key, not behind the joins so far.
        wide = left_lookup(wide, dim, key, columns, counted=fact)
    return wide


def report_rollup(wide: DataFrame, by: str | Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """Aggregates of a wide table, plus the period it covers."""
    return wide.groupBy(*key_list(by)).agg(
        F.count("*").alias("total_records"),
        *[c.alias(name) for name, c in metrics.items()],
        F.min("date_day").alias("period_start"),
        F.max("date_day").alias("period_end"),
    )


def touched_periods(before: DataFrame, batch: DataFrame, keys: str | Sequence[str], period: str) -> list:
    """Periods with rows that a batch adds, changes or moves: those of its rows, and those its keys had before.

    Two narrow scans; the driver gets each period once, None among them for rows without one.
    """
    names = key_list(keys)
    old = before.select(*names, period).join(batch.select(*names).distinct(), names, "left_semi").select(period)
    return [r[0] for r in old.unionByName(batch.select(period)).distinct().collect()]


def in_periods(df: DataFrame, period: str, periods: Sequence) -> Column:
    """Whether a row is of one of the periods, as a condition on literals that a scan can prune by."""
    known = [p for p in periods if p is not None]
    inside = F.col(period).isin(*known) if known else F.lit(False)
    return F.coalesce(inside, F.lit(None in periods)) if None in periods else inside & F.col(period).isNotNull()


def report_incremental(
    report: DataFrame,
    wide: DataFrame,
    periods: Sequence,
    by: str | Sequence[str],
    metrics: Mapping[str, Column],
    period: str,
) -> DataFrame:
    """The report after the wide table changed in some periods: those are aggregated again, all other rows are carried over.

    ``period`` is one of the columns the report is grouped ``by``, so no group reaches into two periods, and every metric,
    distinct counts included, is what a full :func:`report_rollup` gives. ``wide`` is the table after the change; partitioned by
    the period it is read in those periods only. Periods without rows any more leave the report.
    """
    if period not in key_list(by):
        raise ValueError(f"groups of {', '.join(key_list(by))} reach over several values of {period}")
    again = report_rollup(wide.filter(in_periods(wide, period, periods)), by, metrics)
    kept = report.filter(~F.coalesce(in_periods(report, period, periods), F.lit(False)))
    return kept.select(*again.columns).unionByName(again)


def report_build(
    wide: DataFrame, by: str | Sequence[str], metrics: Mapping[str, Column], contract: Mapping[str, str]
) -> DataFrame:
    """A report whose columns and types must be the declared ones."""
    return assert_contract(report_rollup(wide, by, metrics), contract)
