"""Snapshot history in two parts: closed versions, which are only added to, and open ones, which each run writes anew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.history import snapshot_check, snapshot_timestamp
from strata.session import Workspace, path_exists, remove, subfolders

# Runs are numbered folders: closed versions of all runs and open versions of the newest one make the history.
RUN = "_run"
# Open versions of older runs that stay for readers that began before a run ended.
KEPT_RUNS = 1


def runs(spark: SparkSession, folder: str, part: str) -> list[int]:
    """Numbers of the runs whose part is completely written."""
    names = [n for n in subfolders(spark, f"{folder}/{part}") if n.startswith(f"{RUN}=") and path_exists(spark, f"{folder}/{part}/{n}/_SUCCESS")]
    return sorted(int(n.split("=")[1]) for n in names)


def read_history(spark: SparkSession, folder: str) -> DataFrame | None:
    """All versions as of the last complete run; None before the first.

    A run is complete when its open part is: it is written last. Closed versions of a run that died before are not read.
    """
    done = runs(spark, folder, "open")
    if not done:
        return None
    open_part = spark.read.parquet(f"{folder}/open/{RUN}={done[-1]}")
    closed = [f"{folder}/closed/{RUN}={n}" for n in runs(spark, folder, "closed") if n <= done[-1]]
    if not closed:
        return open_part
    # Columns that came later read as NULL in earlier runs.
    return spark.read.schema(open_part.schema).parquet(*closed).unionByName(open_part)


def extend_history(
    spark: SparkSession,
    folder: str,
    source: DataFrame,
    keys: str | Sequence[str],
    run_ts,
    updated_at: str | None = None,
    check_columns: Sequence[str] | None = None,
    hard_deletes: bool = False,
) -> DataFrame:
    """One more look at the source: by ``updated_at``, or by ``check_columns`` (all, if neither is given); returns the history.

    Only open versions are read and joined. Versions that close are added as new files, and no file of the closed part is
    touched; the open versions are written as a new part, which ends the run. A run that dies is as if it had not been, and
    the next one takes its number.
    """
    done = runs(spark, folder, "open")
    number = done[-1] + 1 if done else 0
    before = spark.read.parquet(f"{folder}/open/{RUN}={done[-1]}") if done else None
    if updated_at:
        after = snapshot_timestamp(before, source, keys, updated_at, run_ts, hard_deletes)
    else:
        after = snapshot_check(before, source, keys, check_columns, run_ts, hard_deletes)
    with Workspace(spark, "snapshot") as work:
        after = work.stage(after)
        ended = after.filter(F.col("valid_to").isNotNull())
        remove(spark, f"{folder}/closed/{RUN}={number}")
        if not ended.isEmpty():
            ended.write.parquet(f"{folder}/closed/{RUN}={number}")
        after.filter(F.col("valid_to").isNull()).write.mode("overwrite").parquet(f"{folder}/open/{RUN}={number}")
    for old in done[: len(done) - KEPT_RUNS]:
        remove(spark, f"{folder}/open/{RUN}={old}")
    return read_history(spark, folder)
