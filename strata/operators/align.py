"""Matching the columns of a batch to the columns of its target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nullable(schema: T.StructType) -> T.StructType:
    """The same fields, all nullable."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def staging_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty, fully nullable copy of a target."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in nullable(schema)]
    return spark.range(1).select(*columns).limit(0)


def find_column(name: str, candidates: Sequence[str]) -> str | None:
    """The candidate spelled like ``name``: exact, then lower case, then upper case, then any case."""
    for spelling in (name, name.lower(), name.upper()):
        if spelling in candidates:
            return spelling
    return next((c for c in candidates if c.lower() == name.lower()), None)


def fit(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in the target's type: nested values go into text columns as JSON."""
    if have == want:
        return column
    nested = isinstance(have, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
    if nested and isinstance(want, T.StringType):
        return F.to_json(column)
    if isinstance(want, T.VariantType):
        return F.parse_json(column) if isinstance(have, T.StringType) else F.parse_json(F.to_json(column))
    return column.cast(want)


def column_intersect(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns known to both sides, in target order, under target names and types."""
    picked = []
    for field in target:
        source = find_column(field.name, df.columns)
        if source is not None:
            have = df.schema[source].dataType
            picked.append(fit(F.col(f"`{source}`"), have, field.dataType).alias(field.name))
    if not picked:
        raise ValueError(f"no common columns: batch {df.columns[:10]}, target {target.names[:10]}")
    return df.select(*picked)


def json_encode_nested(df: DataFrame, target: T.StructType) -> DataFrame:
    """Nested values to JSON text where the target column is text."""
    changed = {}
    for field in df.schema:
        match = find_column(field.name, target.names)
        if match is not None and isinstance(target[match].dataType, T.StringType):
            if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
                changed[field.name] = F.to_json(F.col(field.name))
    return df.withColumns(changed) if changed else df


def align_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """A batch in exactly the target's columns; what the batch lacks is NULL."""
    known = column_intersect(df, target)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in target if f.name not in known.columns}
    return known.withColumns(missing).select(*target.names) if missing else known


def append_new_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target and batch stacked; a column only one side has is NULL on the other."""
    return target.unionByName(batch, allowMissingColumns=True)


def widened(target: T.StructType, batch: T.StructType) -> T.StructType:
    """The target's fields followed by the fields only the batch has."""
    extra = [f for f in batch if find_column(f.name, target.names) is None]
    return nullable(T.StructType(list(target) + extra))


def missing_columns(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """Expected columns that are absent and those that are present, any spelling."""
    absent = sorted(c for c in set(expected) if find_column(c, df.columns) is None)
    present = sorted(c for c in set(expected) if find_column(c, df.columns) is not None)
    return absent, present
