"""Table sources: a registry of declared sources, incremental scans, and layer materialisation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.history import snapshot_timestamp
from strata.operators.merge import merge_upsert
from strata.operators.mapping import filter_watermark
from strata.specs import LoadSpec

# A source of a load: anything that turns a session and a contract into a DataFrame.
Reader = Callable[[SparkSession, LoadSpec], DataFrame]


@dataclass
class Registry:
    """Declared sources: (source, table) -> how to read it, and the contract it is loaded under."""

    readers: dict[tuple[str, str], Reader | str] = field(default_factory=dict)
    specs: dict[tuple[str, str], LoadSpec] = field(default_factory=dict)

    def declare(self, source: str, table: str, reader: Reader | str, spec: LoadSpec | None = None) -> None:
        """Register a reader function, a parquet path (anything with a slash) or a catalog table name."""
        self.readers[(source, table)] = reader
        if spec is not None:
            self.specs[(source, table)] = spec

    def source(self, spark: SparkSession, source: str, table: str) -> DataFrame:
        """The relation of a declared source table."""
        if (source, table) not in self.readers:
            raise KeyError(f"source {source}.{table} is not declared")
        reader = self.readers[(source, table)]
        if callable(reader):
            return reader(spark, self.specs.get((source, table)))
        return spark.read.parquet(reader) if "/" in reader else spark.table(reader)

    def tables(self) -> list[tuple[str, str]]:
        return sorted(self.readers)


def source_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Tables of a schema without temporary copies."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return sorted(n for n in names if "_airbyte_tmp" not in n and "_tmp" not in n)


def read_incremental(
    df: DataFrame, column: str | None, watermark=None, full_refresh: bool = False, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows past the watermark, or the whole table without one. The filter reaches the scan; nothing is sorted."""
    rows = df.select(*columns) if columns else df
    if full_refresh or column is None or watermark is None:
        return rows
    return filter_watermark(rows, column, watermark, keep_null=False)


# Steps that a column's range is counted in before it is cut.
STEPS = 1024


def range_predicates(column: str, counts: Mapping[int, int], low: float, width: float, parts: int) -> list[str]:
    """SQL conditions that cut a column into up to ``parts`` ranges of similar numbers of rows, every row in exactly one.

    ``counts`` has the rows of each step of ``width`` from ``low`` on. Neighbouring steps are put together until they hold their
    share; a step with more rows than that stays alone. The first range is open below and takes NULLs, the last is open
    above, so rows that come after the count are in a range too.
    """
    share, cuts, held = sum(counts.values()) / max(1, parts), [], 0
    for step in sorted(counts):
        if held and held + counts[step] / 2 > share and len(cuts) < parts - 1:
            cuts.append(low + step * width)
            held = 0
        held += counts[step]
    cuts = [int(c) if float(c).is_integer() else c for c in cuts]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *middle, f"{column} >= {cuts[-1]}"]


def newer_condition(column: str | None, watermark) -> str:
    """The watermark filter as a condition that databases understand."""
    if column is None or watermark is None:
        return "1 = 1"
    value = str(watermark) if isinstance(watermark, (int, float)) else "'" + str(watermark).replace("'", "''") + "'"
    return f"{column} > {value}"


def bounds_query(table: str, column: str, condition: str) -> str:
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table} WHERE {condition}"


def steps_query(table: str, column: str, condition: str, low: float, width: float) -> str:
    """Rows per step of a numeric column; an aggregate, so a row per step is all that leaves the database."""
    step = f"FLOOR(({column} - {low}) / {width})"
    return f"SELECT {step} AS step, COUNT(*) AS n FROM {table} WHERE {condition} AND {column} IS NOT NULL GROUP BY {step}"


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    watermark=None,
    partition_column: str | None = None,
    partitions: int = 32,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Incremental scan of a database table; the watermark filter runs in the database.

    With a numeric ``partition_column`` the table is read over several connections. The database is asked for the column's bounds and
    then for the rows in each of ``STEPS`` steps between them, and the ranges are cut so that they hold similar numbers of
    rows: ids in one corner of their range do not leave one connection with nearly all of them. Dates and timestamps are cut into
    equal strides.
    """
    base = {"url": url, **(options or {})}

    def asked(query: str) -> DataFrame:
        return spark.read.format("jdbc").options(**base, query=query).load()

    whole = spark.read.format("jdbc").options(**base, dbtable=table)
    if not partition_column:
        return read_incremental(whole.load(), column, watermark)
    condition = newer_condition(column, watermark)
    low, high = asked(bounds_query(table, partition_column, condition)).first()
    if low is None:
        return read_incremental(whole.load(), column, watermark)
    if isinstance(low, (dt.date, dt.datetime)):
        ends = {"partitionColumn": partition_column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions)}
        return read_incremental(whole.options(**ends).load(), column, watermark)
    low, high = float(low), float(high)
    width = max((high - low) / STEPS, 1.0 if low.is_integer() and high.is_integer() else 1e-9)
    counts = {int(r[0]): int(r[1]) for r in asked(steps_query(table, partition_column, condition, low, width)).collect()}
    ranges = range_predicates(partition_column, counts, low, width, partitions)
    rows = spark.read.jdbc(url, table, predicates=ranges, properties=dict(options or {}))
    return read_incremental(rows, column, watermark)


def materialize(
    df: DataFrame,
    name: str,
    kind: str = "table",
    partition_by: Sequence[str] = (),
    folder: str | None = None,
    unique_key: Sequence[str] = (),
    updated_at: str | None = None,
    run_ts=None,
) -> DataFrame:
    """Publish a model as a view, a table, an incremental table or a snapshot, and return the published relation.

    An incremental model is upserted by ``unique_key``, the newest ``updated_at`` winning; a snapshot keeps the
    history of its rows by ``updated_at`` as of ``run_ts``. Both, and a table for which a ``folder`` is given, are published as new
    versions below it, so a model may read its own table and a failed write leaves the old one. A table without a folder is
    overwritten in place, and may be partitioned.
    """
    spark = df.sparkSession
    if kind == "table" and folder and partition_by:
        raise ValueError("a table is either published in versions or partitioned")
    if kind in ("incremental", "snapshot") or kind == "table" and folder:
        # The load loop builds on the sources of this package.
        from strata.plans.load import current, publish

        old = current(spark, name) if spark.catalog.tableExists(name) else None
        if kind == "table":
            new = df
        elif kind == "snapshot":
            new = snapshot_timestamp(old, df, list(unique_key), updated_at, run_ts)
        else:
            new = df if old is None else merge_upsert(old, df, list(unique_key), updated_at)
        publish(new, name, f"{folder}/{name}")
        return current(spark, name)
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)
    else:
        raise ValueError(f"kind must be view, table, incremental or snapshot, not {kind!r}")
    return spark.table(name)


def layer_schema(name: str | None, default: str, production: bool, pattern: str = "{name}_dev") -> str:
    """Schema a layer is published in: its own name in production, a marked name elsewhere."""
    if name is None:
        return default
    return name.strip() if production else pattern.format(name=name.strip())
