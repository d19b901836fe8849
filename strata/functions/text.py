"""Text and JSON expressions and the registry of named transforms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.keys import _col
from strata.functions.time import warehouse_ts


def clean_string(column: str | Column) -> Column:
    """Lower case without surrounding blanks."""
    return F.lower(F.trim(_col(column)))


def to_str(column: str | Column) -> Column:
    """Text form; NULL stays NULL."""
    return _col(column).cast("string")


def json_dump(column: str | Column) -> Column:
    """JSON text of any value, scalars included; NULL stays NULL."""
    c = _col(column)
    # to_json takes no bare scalars: encode a one-element array and cut its brackets.
    text = F.to_json(F.array(c), {"ignoreNullFields": "false"})
    return F.when(c.isNotNull(), F.substring(text, F.lit(2), F.length(text) - 2))


def yes_flag(column: str | Column) -> Column:
    """``'Y'`` is true, everything else false."""
    return F.coalesce(_col(column) == "Y", F.lit(False))


def json_value(column: str | Column, path: str, as_type: str) -> Column:
    """A typed field of JSON text, NULL where the text, the path or the type does not fit."""
    return F.try_variant_get(F.try_parse_json(_col(column)), f"$.{path}", as_type)


# Transforms a field mapping may name. Extend with ``TRANSFORMS["name"] = column_function``.
TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "to_str": to_str,
    "warehouse_ts": warehouse_ts,
    "redshift_ts": warehouse_ts,
    "json_dump": json_dump,
}


def transform(name: str | None, column: Column) -> Column:
    """Apply a named transform; an unknown name is an error, not a silent pass-through."""
    if not name:
        return column
    if name not in TRANSFORMS:
        raise ValueError(f"unknown transform {name!r}; known: {', '.join(sorted(TRANSFORMS))}")
    return TRANSFORMS[name](column)
