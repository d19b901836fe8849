"""The load-state table as a partitioned folder: one partition per loaded table, so loads of different tables don't meet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.align import align_by_name, staging_like
from strata.operators.watermarks import STATE_KEY, STATE_SCHEMA
from strata.session import path_exists
from strata.specs import LoadSpec


def own_rows(state: DataFrame, spec: LoadSpec) -> DataFrame:
    """The state of one table."""
    for k, v in zip(STATE_KEY, (spec.layer, spec.target_schema, spec.target_table)):
        state = state.filter(F.col(k) == v)
    return state


def read_state(spark: SparkSession, path: str, spec: LoadSpec | None = None) -> DataFrame:
    """The state of all tables, or of one, which reads its partition only. A folder that isn't there is an empty table."""
    if not path_exists(spark, path):
        return staging_like(spark, STATE_SCHEMA)
    # Partition values are text, whatever they look like.
    state = spark.read.schema(STATE_SCHEMA).parquet(path).select(*STATE_SCHEMA.names)
    return state if spec is None else own_rows(state, spec)


def write_state(rows: DataFrame, path: str) -> None:
    """Replace the partitions of the tables that have rows, and no others."""
    rows = align_by_name(rows, STATE_SCHEMA).select(*STATE_SCHEMA.names)
    # A table's state is a row, so one small file per partition is what there is to write.
    rows = rows.repartition(*STATE_KEY)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*STATE_KEY).parquet(path)
