"""Identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Part separator and NULL stand-in of surrogate keys. Existing keys depend on both.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def safe_id(column: str | Column) -> Column:
    """An identifier as text, so ids of different types join."""
    return _col(column).cast("string")


def surrogate_key(*columns: str | Column) -> Column:
    """MD5 over the text of one or more columns; NULL and empty text give different keys."""
    if not columns:
        raise ValueError("a surrogate key needs at least one column")
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def any_null(columns) -> Column:
    """True where any of the columns is NULL."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | _col(c).isNull()
    return cond


def any_missing(columns) -> Column:
    """True where any key part is NULL or empty text; ``0`` is a valid key."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | _col(c).isNull() | (_col(c).cast("string") == "")
    return cond


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
