"""Reading source data and writing results."""

from strata.sources.files import (
    read_checked,
    read_csv,
    read_ndjson,
    read_ndjson_tolerant,
    read_wrapped_json,
    write_ndjson,
)
from strata.sources.tables import Registry, materialize, read_incremental, read_jdbc, source_tables

__all__ = [
    "Registry",
    "materialize",
    "read_checked",
    "read_csv",
    "read_incremental",
    "read_jdbc",
    "read_ndjson",
    "read_ndjson_tolerant",
    "read_wrapped_json",
    "source_tables",
    "write_ndjson",
]
