"""Side-by-side comparison of a Spark query with its SQL in DuckDB. No code of the package is used here."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t) or pa.types.is_string_view(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def _rows(t: pa.Table) -> list[tuple]:
    names = sorted(t.column_names)
    columns = [t.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr) if columns else []


def difference(spark_table: pa.Table, sql_table: pa.Table) -> str | None:
    """None when names, types, row count and all values agree."""
    a = {f.name: _plain(f.type) for f in spark_table.schema}
    b = {f.name: _plain(f.type) for f in sql_table.schema}
    if a != b:
        return f"schema: {sorted(set(a.items()) - set(b.items()))} against {sorted(set(b.items()) - set(a.items()))}"
    if spark_table.num_rows != sql_table.num_rows:
        return f"rows: {spark_table.num_rows} against {sql_table.num_rows}"
    for x, y in zip(_rows(spark_table), _rows(sql_table)):
        if repr(x) != repr(y):
            return f"values: {x} against {y}"
    return None
