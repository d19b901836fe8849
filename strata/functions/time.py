"""Date and time expressions. The clock is always an argument, never read inside an expression."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.keys import _col

# Text given for a missing time, and the zero dates some databases export.
EPOCH_TEXT = "1970-01-01 00:00:00"
ZERO_DATES = ("0000-00-00 00:00:00", "0000-00-00")


def clock(value: dt.datetime | dt.date | str | Column) -> Column:
    """A run time as a timestamp without zone."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def warehouse_ts(column: str | Column) -> Column:
    """ISO 8601 to ``yyyy-MM-dd HH:mm:ss`` text; NULL and blank become the epoch.

    The zone mark, fraction and ``+hh:mm`` are cut off without shifting the clock; the time part
    is cut to eight characters, which also removes a negative offset. Missing seconds are not added.
    """
    text = F.regexp_replace(_col(column).cast("string"), r"^\s+|\s+$", "")
    # Day and time are split at the first T or, in text without a T, at the first blank; the time
    # ends at a fraction, a plus sign or after eight characters.
    split = r"(?s)^(?:([^T]*)T|([^T ]*) (?=[^T]*$))([^.+]{0,8}).*$"
    both = F.regexp_replace(F.translate(text, "Zz", ""), split, "$1$2 $3")
    full = F.regexp_replace(both, r"^([^ ]*)$", "$1 00:00:00")
    return F.when(text.isNull() | (text == ""), EPOCH_TEXT).otherwise(full)


def null_zero_date(column: str | Column, empty_is_null: bool = False) -> Column:
    """Zero dates to NULL; empty text too if the column holds dates."""
    c = _col(column)
    bad = c.isin(*ZERO_DATES, "") if empty_is_null else c.isin(*ZERO_DATES)
    return F.when(~bad, c)


def wall_micros(column: str | Column) -> Column:
    """Microseconds of a wall-clock time since 1970; no time zone takes part in it."""
    t = _col(column).cast("timestamp_ntz")
    days = F.unix_date(t.cast("date")).cast("bigint")
    seconds = F.hour(t) * 3600 + F.minute(t) * 60
    fraction = (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    return days * 86_400_000_000 + seconds.cast("bigint") * 1_000_000 + fraction


def hours_between(later: str | Column, earlier: str | Column) -> Column:
    """Hours from ``earlier`` to ``later``, from whole microseconds."""
    return (wall_micros(later) - wall_micros(earlier)) / F.lit(3_600_000_000.0)
