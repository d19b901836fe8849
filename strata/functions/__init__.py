"""Column expressions. Everything here is a built-in Spark expression; nothing runs in Python per row."""

from strata.functions.keys import safe_id, surrogate_key
from strata.functions.text import TRANSFORMS, clean_string, json_dump, to_str, transform, yes_flag
from strata.functions.time import hours_between, null_zero_date, warehouse_ts

__all__ = [
    "TRANSFORMS",
    "clean_string",
    "hours_between",
    "json_dump",
    "null_zero_date",
    "safe_id",
    "surrogate_key",
    "to_str",
    "transform",
    "warehouse_ts",
    "yes_flag",
]
