"""The calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import surrogate_key

# First day of the calendar and days it runs past the clock.
DEFAULT_START = dt.date(2020, 1, 1)
DAYS_AHEAD = 365


def _day(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value)[:10])


def date_spine(spark: SparkSession, start=DEFAULT_START, end=None, as_of=None, last=None) -> DataFrame:
    """One row per day from ``start`` up to but not including ``end`` (a year past ``as_of`` by default).

    ``last`` names the last day instead; all days from 0001-01-01 to 9999-12-31 can be covered.
    """
    first = _day(start)
    if last is not None:
        days = (_day(last) - first).days + 1
    else:
        days = ((_day(end) if end is not None else _day(as_of) + dt.timedelta(days=DAYS_AHEAD)) - first).days
    if days <= 0:
        raise ValueError("a calendar covers one day at least")
    return spark.range(days).select(
        F.date_add(F.lit(first.isoformat()).cast("date"), F.col("id").cast("int")).alias("date_day")
    )


def dim_date(
    spark: SparkSession, as_of, start=DEFAULT_START, end=None, fiscal_start_month: int | None = None, last=None
) -> DataFrame:
    """Calendar dimension, one row per day; weeks begin on Monday, day-of-week numbers on Sunday = 0."""
    d, today = F.col("date_day"), F.lit(_day(as_of))
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    dow = F.dayofweek(d) - 1
    week, month1, quarter1, year1 = (F.trunc(d, unit) for unit in ("week", "month", "quarter", "year"))
    columns = {
        "date_sk": surrogate_key("date_day"),
        "date_day": d,
        "year_number": year,
        "year_text": year.cast("string"),
        "quarter_number": quarter,
        "year_quarter": F.concat(year, F.lit("-Q"), quarter),
        "month_number": month,
        "month_name": F.date_format(d, "MMMM"),
        "month_short": F.date_format(d, "MMM"),
        "year_month": F.concat(year, F.lit("-"), F.lpad(month.cast("string"), 2, "0")),
        "week_number": F.weekofyear(d),
        "day_of_week_number": dow,
        "day_of_week_name": F.date_format(d, "EEEE"),
        "day_of_week_short": F.date_format(d, "EEE"),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "is_weekend": dow.isin(0, 6),
        "is_weekday": dow.between(1, 5),
        "is_today": d == today,
        "is_yesterday": d == F.date_sub(today, 1),
        "week_start_date": week,
        "week_end_date": F.date_add(week, 6),
        "month_start_date": month1,
        "month_end_date": F.last_day(d),
        "quarter_start_date": quarter1,
        "quarter_end_date": F.date_sub(F.add_months(quarter1, 3), 1),
        "year_start_date": year1,
        "year_end_date": F.date_sub(F.add_months(year1, 12), 1),
    }
    calendar = date_spine(spark, start, end, as_of, last).select(*[c.alias(n) for n, c in columns.items()])
    return with_fiscal(calendar, fiscal_start_month) if fiscal_start_month else calendar


def with_fiscal(calendar: DataFrame, start_month: int) -> DataFrame:
    """Add the fiscal year, named after the calendar year it starts in, and the fiscal month."""
    year, month, begun = F.col("year_number"), F.col("month_number"), F.col("month_number") >= start_month
    return calendar.withColumns(
        {
            "fiscal_year": F.when(begun, year).otherwise(year - 1),
            "fiscal_month_number": F.when(begun, month - (start_month - 1)).otherwise(month + (13 - start_month)),
        }
    )
