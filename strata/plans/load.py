"""The load loop: window, map, filter, deduplicate, upsert or replace, remember the watermark.

:func:`load_batch` and :func:`run_load` only describe the new tables; :func:`execute_load`,
:func:`publish` and :func:`merge_partitions` write them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import any_missing
from strata.operators.align import staging_like
from strata.operators.incremental import as_timestamp
from strata.operators.mapping import filter_watermark, map_fields
from strata.operators.merge import full_refresh, merge_upsert
from strata.operators.profile import custom_metadata, run_metadata
from strata.operators.quality import load_stats, table_checks
from strata.operators.sizing import fits_broadcast
from strata.operators.watermarks import (
    STATE_KEY,
    STATE_SCHEMA,
    watermark_mark_started,
    watermark_set_status,
    watermark_update,
)
from strata.plans.state import read_state, write_state
from strata.session import Workspace, remove, staged
from strata.sources.files import CHECKED, FILE, LINE, WRONG, read_checked
from strata.specs import LoadSpec, key_list

DEFAULT_WINDOW_DAYS = 90
# Partition values put into one scan as literals; more take several scans.
PARTITION_LITERALS = 5_000
# Rows of a file that a merge by file writes beyond those it replaces.
ROWS_PER_FILE = 1_000_000
# Folder in a partitioned table that holds the new content of partitions until they are replaced; readers skip it.
PENDING = "_pending"

# Extractor of a load: gets the window as ISO dates.
Extract = Callable[[SparkSession, LoadSpec, str, str], DataFrame]


@dataclass(frozen=True)
class LoadResult:
    """The tables after a load. ``status`` is ``success`` or ``no_new_data``."""

    target: DataFrame
    state: DataFrame
    stats: DataFrame
    status: str = "success"
    metadata: DataFrame | None = None  # what the run did, one row
    profile: DataFrame | None = None  # the declared profile of the loaded table
    checks: DataFrame | None = None  # the standing checks of the loaded table
    rejects: DataFrame | None = None  # lines of files with something wrong: file, line, columns


def _one_key(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    values = (spec.layer, spec.target_schema, spec.target_table)
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in zip(STATE_KEY, values)])


def current_watermark(state: DataFrame, spec: LoadSpec) -> str | None:
    """Stored watermark of a table; the state table has one row for it."""
    own = state.filter(
        (F.col("layer") == spec.layer)
        & (F.col("target_schema") == spec.target_schema)
        & (F.col("target_table") == spec.target_table)
    )
    row = own.orderBy(F.col("updated_at").desc_nulls_last()).select("watermark_value").first()
    return row[0] if row else None


def last_run_at(state: DataFrame, spec: LoadSpec):
    """When a table was last loaded; None if never."""
    own = dict(zip(STATE_KEY, (spec.layer, spec.target_schema, spec.target_table)))
    for k, v in own.items():
        state = state.filter(F.col(k) == v)
    return state.agg(F.max("last_run_at")).first()[0]


def extraction_window(spec: LoadSpec, watermark: str | None, as_of, days: int = DEFAULT_WINDOW_DAYS) -> tuple[str, str]:
    """ISO dates from the day of the watermark (or a default span back) to the day of the clock."""
    today = as_timestamp(as_of).date()
    if spec.incremental_strategy == "timestamp" and watermark:
        return watermark[:10], today.isoformat()
    return (today - dt.timedelta(days=days)).isoformat(), today.isoformat()


def watermark_rows(batch: DataFrame, spec: LoadSpec, run_ts) -> DataFrame:
    """The batch's state update: typed maximum as text, or the run time for fully replaced tables.

    Empty when an incremental batch has no usable value.
    """
    spark = batch.sparkSession
    key = [
        F.lit(spec.layer).alias("layer"),
        F.lit(spec.target_schema).alias("target_schema"),
        F.lit(spec.target_table).alias("target_table"),
    ]
    n = F.count("*").alias("rows_processed")
    if spec.incremental_column:
        c = F.col(spec.incremental_column)
        if isinstance(batch.schema[spec.incremental_column].dataType, T.StringType):
            c = F.when(c != "", c)
        top = batch.agg(F.max(c).cast("string").alias("watermark_value"), n)
        return top.filter(F.col("watermark_value").isNotNull()).select(*key, "watermark_value", "rows_processed")
    if spec.incremental_strategy == "full_refresh":
        value = F.lit(as_timestamp(run_ts).strftime("%Y-%m-%dT%H:%M:%S")).alias("watermark_value")
        return batch.agg(n).select(*key, value, "rows_processed")
    return staging_like(
        spark, T.StructType([STATE_SCHEMA[c] for c in (*STATE_KEY, "watermark_value", "rows_processed")])
    )


def load_batch(
    target: DataFrame,
    batch: DataFrame,
    spec: LoadSpec,
    state: DataFrame,
    run_ts,
    stats: DataFrame | None = None,
    **merge_options,
) -> LoadResult:
    """New target and state: replaced for ``full_refresh``, upserted for every other strategy.

    An empty batch changes nothing but the status, so an empty extract cannot wipe a table.
    """
    spark = batch.sparkSession
    keys = list(spec.primary_key)
    stats = load_stats(batch, keys) if stats is None else stats
    if batch.isEmpty():
        seen = _one_key(spark, spec).withColumns(
            {"status": F.lit("no_new_data"), "error_message": F.lit(None).cast("string")}
        )
        return LoadResult(target, watermark_set_status(state, seen, run_ts), stats, "no_new_data")
    if spec.incremental_strategy == "full_refresh":
        new_target = full_refresh(target, batch, keys, spec.incremental_column)
    else:
        new_target = merge_upsert(target, batch, keys, spec.incremental_column, **merge_options)
    return LoadResult(new_target, watermark_update(state, watermark_rows(batch, spec, run_ts), run_ts), stats)


class RejectedLines(ValueError):
    """More lines of a load's files are wrong than it tolerates. ``rejects`` has them, ``counts`` says how many of which kind."""

    def __init__(self, path: str, counts: dict[str, int], rejects: DataFrame):
        examples = [f"{r['file']}: {r['line'][:200]}" for r in rejects.limit(3).collect()]
        super().__init__(f"{path}: {counts['rejected']} of {counts['lines']} lines rejected, such as {'; '.join(examples)}")
        self.counts, self.rejects = counts, rejects


@dataclass(frozen=True)
class FileBatch:
    """A batch from files: its records, its rejected lines (file, line, columns), and counts of both."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]  # lines, malformed, rejected, and wrong:<column> for columns with values that don't fit


def stage_files(spark: SparkSession, path: str, schema: T.StructType, kind: str | None = None, label: str = "files") -> FileBatch:
    """NDJSON or CSV files as a staging table, read once, in those of the target's columns that any line names.

    The kind is told from the path unless given. What is wrong is counted while the staging table is written. A line that is no
    record is a reject without columns; a record with values that don't fit stays in the batch with NULL for those, and is a
    reject with their columns' names.
    """
    bare = path.rstrip("/").lower().removesuffix(".gz")
    rows, named = read_checked(spark, path, schema, kind or ("csv" if bare.endswith(".csv") else "ndjson"))
    seen = Observation(label)
    no_record = F.col(WRONG).isNull()
    metrics = [F.count("*").alias("lines"), F.count_if(no_record).alias("malformed"), F.count_if(F.col(LINE).isNotNull()).alias("rejected")]
    fields = [f.name for f in schema if f.name in rows.columns]
    metrics += [F.count_if(F.array_contains(WRONG, c)).alias(f"wrong:{c}") for c in fields]
    metrics += [F.count_if(named[c]).alias(f"named:{c}") for c in fields]
    table = staged(rows.observe(seen, *metrics).select(*fields, *CHECKED), label)
    counts = seen.get
    kept = [c for c in fields if counts[f"named:{c}"]]
    rejects = table.filter(F.col(LINE).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.coalesce(WRONG, F.array().cast("array<string>")).alias("columns")
    )
    told = {k: n for k, n in counts.items() if not k.startswith("named:") and (n or ":" not in k)}
    return FileBatch(table.filter(F.col(WRONG).isNotNull()).select(*kept), rejects, told)


def load_files(
    path: str,
    target: DataFrame,
    spec: LoadSpec,
    state: DataFrame,
    run_ts,
    kind: str | None = None,
    tolerate: int | None = 0,
    rejects_folder: str | None = None,
    **merge_options,
) -> LoadResult:
    """:func:`load_batch` from NDJSON or CSV files, see :func:`stage_files`.

    Files hold mapped records: neither field mappings nor the watermark filter apply to them. Columns that no line names stay as they
    are in the target. More than ``tolerate`` rejected lines raise :class:`RejectedLines` before anything is merged (None: any number
    may be). ``rejects_folder`` keeps the rejected lines of all loads, those that raise included, as a
    parquet table with the load's name and time. The result's ``stats`` count malformed lines, and values that don't fit by column.
    """
    spark = target.sparkSession
    batch = stage_files(spark, path, target.schema, kind, spec.name)
    if rejects_folder and batch.counts["rejected"]:
        stamped = batch.rejects.select(F.lit(spec.name).alias("load"), F.lit(as_timestamp(run_ts)).cast("timestamp_ntz").alias("run_ts"), "*")
        stamped.write.mode("append").parquet(rejects_folder)
    if tolerate is not None and batch.counts["rejected"] > tolerate:
        raise RejectedLines(path, batch.counts, batch.rejects)
    stats = load_stats(batch.rows, list(spec.primary_key), rejected=batch.counts)
    return replace(load_batch(target, batch.rows, spec, state, run_ts, stats, **merge_options), rejects=batch.rejects)


def prepare_batch(raw: DataFrame, spec: LoadSpec, watermark: str | None, run_ts) -> tuple[DataFrame, DataFrame]:
    """Mapped and filtered batch, and its statistics.

    Without field mappings the records pass as they are, key-less ones included.
    """
    keys = list(spec.primary_key)
    mapped = map_fields(raw, spec.field_mappings, run_ts, spec.auto_timestamps) if spec.field_mappings else raw
    by_time = spec.incremental_strategy == "timestamp" and spec.incremental_column and watermark
    column, bound = (spec.incremental_column, watermark) if by_time else (None, None)
    stats = load_stats(mapped, keys, column, bound)
    if spec.field_mappings:
        mapped = mapped.filter(~any_missing(keys))
    else:
        stats = stats.withColumns({"pk_missing": F.lit(0).cast("bigint"), "mapped": F.col("total_raw")})
    return (filter_watermark(mapped, column, bound) if by_time else mapped), stats


def run_load(
    raw: DataFrame,
    target: DataFrame,
    state: DataFrame,
    spec: LoadSpec,
    run_ts,
    stage: bool = True,
    **merge_options,
) -> LoadResult:
    """One whole load as DataFrames.

    ``stage`` writes the extract to the shared folder first, as a real staging table: the source is then read
    once for the counts, the merge, the watermark and the emptiness test, which all see the same rows, and the
    loss of an executor costs no second reading. A staged batch is measured, and joined by broadcast if it is small.
    """
    spark = raw.sparkSession
    watermark = current_watermark(state, spec)
    started = watermark_mark_started(state, _one_key(spark, spec), run_ts)
    batch, stats = prepare_batch(staged(raw, spec.name) if stage else raw, spec, watermark, run_ts)
    if stage:
        merge_options.setdefault("small_batch", True)
    return load_batch(target, batch, spec, started, run_ts, stats, **merge_options)


class MovedTarget(RuntimeError):
    """Another load published a new version of a table while this one was made."""


def table_version(spark: SparkSession, table: str) -> str:
    """The folder of a table's newest version."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return rows["Location"]


def publish(df: DataFrame, table: str, folder: str, buckets: int = 0, keys: Sequence[str] = (), expected: str | None = None) -> None:
    """Make ``df`` the new content of a catalog table, which ``df`` may be reading.

    The content goes to a new folder below ``folder`` and the table is then pointed at it, so the
    switch is one catalog change: readers see the old or the new version, and a failed write leaves
    the old one in place. Old versions stay until their folders are removed.

    ``buckets`` stores the table bucketed and sorted by ``keys``; upserts by exactly these keys then
    leave the table's rows where they are. It is for tables whose rows all have a key: rows without
    one would share a bucket. A table that is bucketed stays so; other buckets or keys than its own are an error, and so is a
    column of another type, before anything is written. A column that ``df`` lacks reads as NULL.

    ``expected`` is the :func:`table_version` that ``df`` was made from. If the table has another one when the switch is due, it stays and
    :class:`MovedTarget` is raised; the catalog has no compare-and-set, so only a switch in the same instant goes unseen.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        own, own_keys = bucketing(spark, table)
        if buckets and (buckets, list(keys)) != (own, own_keys):
            raise ValueError(f"{table} has {own} buckets by {own_keys}, not {buckets} by {list(keys)}")
        buckets, keys = own, own_keys
        have = {f.name.lower(): f.dataType for f in spark.table(table).schema}
        changed = [f.name for f in df.schema if have.get(f.name.lower(), f.dataType) != f.dataType]
        if changed:
            raise ValueError(f"{table} has other types for {', '.join(changed)}")
    version = uuid.uuid4().hex
    path = f"{folder.rstrip('/')}/{version}"
    if buckets:
        # One task and one file per bucket.
        rows = df.repartition(buckets, *keys)
        writer = rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
        name = f"{table}_{version}" if spark.catalog.tableExists(table) else table
        writer.saveAsTable(name)
        if name == table:
            return
        spark.sql(f"DROP TABLE {name}")  # only the entry: the files belong to the path
    else:
        df.write.parquet(path)
        if not spark.catalog.tableExists(table):
            spark.catalog.createTable(table, path, "parquet", df.schema)
            return
    if expected is not None:
        spark.catalog.refreshTable(table)
        if table_version(spark, table) != expected:
            remove(spark, path)
            raise MovedTarget(f"{table} was published anew since {expected}")
    known = {f.name.lower() for f in spark.table(table).schema}
    added = [f for f in df.schema if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def drop_versions(spark: SparkSession, table: str, folder: str, keep: int = 1) -> list[str]:
    """Remove the folders of old versions of a table, but for the current one and the newest ``keep`` before it; returns their names.

    A reader of a removed version fails, so keep as many as are published while the longest reader runs.
    """
    new = spark._jvm.org.apache.hadoop.fs.Path
    files = new(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    now = new(table_version(spark, table)).getName()
    found = [(s.getModificationTime(), s.getPath().getName()) for s in files.listStatus(new(folder)) if s.isDirectory()]
    # Versions are named by publish; other folders are left alone.
    old = sorted(f for f in found if f[1] != now and len(f[1]) == 32 and all(c in "0123456789abcdef" for c in f[1]))
    gone = [name for _, name in old[: max(0, len(old) - keep)]]
    for name in gone:
        files.delete(new(f"{folder.rstrip('/')}/{name}"), True)
    return gone


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets and bucket columns of a table; 0 and none if it is not bucketed."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    names = rows.get("Bucket Columns", "").strip("[]")
    return int(rows.get("Num Buckets") or 0), [n.strip("` ") for n in names.split(",") if n.strip()]


def by_bucket(spark: SparkSession, table: str, keys: str | Sequence[str]) -> bool:
    """Whether a table is bucketed by exactly these keys."""
    buckets, own = bucketing(spark, table)
    return buckets > 0 and own == key_list(keys)


def current(spark: SparkSession, table: str) -> DataFrame:
    """The newest published version of a table, also when another session published it."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def merge_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: str | Sequence[str],
    partition_by: str,
    order_by: str | None = None,
    **merge_options,
) -> None:
    """Upsert into a partitioned parquet table, reading and rewriting only the partitions of the batch.

    The partition column must be part of the key, so a key never moves between partitions. The new content of
    the touched partitions is complete in the table's folder before any is replaced.
    """
    names = key_list(keys)
    if partition_by not in names:
        raise ValueError(f"{partition_by} must be part of the key {', '.join(names)}")
    replace_pending(spark, path, partition_by)
    target = spark.read.parquet(path)
    with Workspace(spark, "batch") as work:
        batch = work.stage(batch)  # one reading for the touched partitions and for the merge
        touched = batch.select(F.col(partition_by).cast(target.schema[partition_by].dataType)).distinct()
        old = touched_partitions(target, partition_by, [r[0] for r in touched.collect()])
        merged = merge_upsert(old, batch, names, order_by, **merge_options)
        # A rebalance keeps files at a sensible size and splits a partition value that holds most rows.
        merged.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(f"{path}/{PENDING}")
    replace_pending(spark, path, partition_by)


def touched_partitions(target: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows of the listed partitions. Values go into scans as literals, so every scan lists only its own partitions."""
    known = [v for v in values if v is not None]
    out = target.filter(F.col(column).isNull()) if None in values else None
    for i in range(0, len(known), PARTITION_LITERALS):
        part = target.filter(F.col(column).isin(*known[i : i + PARTITION_LITERALS]))
        out = part if out is None else out.unionByName(part)
    return target.limit(0) if out is None else out


def replace_pending(spark: SparkSession, path: str, partition_by: str) -> None:
    """Put complete pending partitions in the place of the old ones, then forget the pending folder.

    A partition's old folder is removed and the pending one moved there; nothing is written twice. A run that dies in
    between leaves the rest pending, and the next merge puts it in place before anything else. Pending rows that are not
    in folders by partition, as earlier versions left them, are written to their partitions.
    """
    new = spark._jvm.org.apache.hadoop.fs.Path
    pending = new(f"{path}/{PENDING}")
    files = pending.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(new(pending, "_SUCCESS")):
        flat = False
        for entry in files.listStatus(pending):
            name = entry.getPath().getName()
            if entry.isDirectory() and name.startswith(f"{partition_by}="):
                files.delete(new(f"{path}/{name}"), True)
                files.rename(entry.getPath(), new(f"{path}/{name}"))
            elif entry.isFile() and not name.startswith(("_", ".")):
                flat = True
        if flat:
            rows = spark.read.parquet(f"{path}/{PENDING}")
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
    files.delete(pending, True)


def merge_files(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: str | Sequence[str],
    order_by: str | None = None,
    **merge_options,
) -> list[str]:
    """Upsert into an unpartitioned parquet folder, reading whole and rewriting only the files that hold keys of the batch.

    A scan of the key columns within the batch's range of keys tells those files; the others stay as they are. Rewritten rows are dealt by
    ranges of the key into as many files as there were, so files keep to their ranges and the next batch touches few too. The new
    files and the list of the old ones are complete in the folder before any is replaced; a run that dies in
    between is finished by the next. While files are replaced, a reader that lists the folder may see rows of both; tables that are read
    meanwhile belong to :func:`publish`. Returns the replaced files, one entry for each.
    """
    names = key_list(keys)
    replace_files(spark, path)
    target = spark.read.parquet(path)
    with Workspace(spark, "batch") as work:
        batch = work.stage(batch)
        touched = touched_files(target, batch, names)
        old = spark.read.schema(target.schema).parquet(*touched) if touched else target.limit(0)
        merged = merge_upsert(old, batch, names, order_by, **merge_options)
        files = max(len(touched), -(-batch.count() // ROWS_PER_FILE), 1)
        merged.repartitionByRange(files, *names).write.mode("overwrite").parquet(f"{path}/{PENDING}/rows")
    replaced = spark.createDataFrame([(f,) for f in touched], "value string")
    replaced.coalesce(1).write.mode("overwrite").text(f"{path}/{PENDING}/replaced")
    replace_files(spark, path)
    return touched


def touched_files(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """Files of the target that hold a key of the batch, from a scan of nothing but keys."""
    wanted = batch.select(*[F.col(k).cast(target.schema[k].dataType).alias(k) for k in keys]).dropna().distinct()
    low, high = wanted.agg(F.min(keys[0]), F.max(keys[0])).first()
    if low is None:
        return []
    scan = target.select(*keys, F.col("_metadata.file_path").alias("_file")).filter(F.col(keys[0]).between(F.lit(low), F.lit(high)))
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    return sorted(r["_file"] for r in scan.join(wanted, list(keys), "left_semi").select("_file").distinct().collect())


def replace_files(spark: SparkSession, path: str) -> None:
    """Put complete pending files in the place of those they replace, then forget them."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    pending, rows = new(f"{path}/{PENDING}"), new(f"{path}/{PENDING}/rows")
    files = pending.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(new(f"{path}/{PENDING}/replaced/_SUCCESS")):
        replaced = [r["value"] for r in spark.read.text(f"{path}/{PENDING}/replaced").collect()]
        for f in files.listStatus(rows) if files.exists(rows) else ():
            if f.getPath().getName().endswith(".parquet"):
                files.rename(f.getPath(), new(f"{path}/{f.getPath().getName()}"))
        for old in replaced:
            files.delete(new(old), False)
    files.delete(pending, True)


def _state_of(spark: SparkSession, state_table: str, spec: LoadSpec) -> DataFrame:
    return read_state(spark, state_table, spec) if "/" in state_table else current(spark, state_table)


def _save_state(state: DataFrame, state_table: str, folder: str) -> None:
    if "/" in state_table:
        write_state(state, state_table)
    else:
        publish(state, state_table, f"{folder}/{state_table}")


def execute_load(
    spark: SparkSession,
    spec: LoadSpec,
    extract: Extract,
    target_table: str,
    state_table: str,
    folder: str,
    run_ts,
) -> LoadResult:
    """Extract, load and publish one table; a failure is recorded in the state table and raised.

    The extract is staged, so the source is read once. The result also holds what the run did, the declared profile and
    the standing checks of the table.

    ``state_table`` is a folder (anything with a slash), of which a load reads and replaces its own table's partition only, so
    loads of different tables may run at once; or a catalog table, which is replaced as a whole. A load whose target was
    published anew by another one meanwhile raises :class:`MovedTarget` and leaves it.

    Target and state are published one after the other. A crash between them replays the batch on
    the next run, which the upsert makes harmless.
    """
    try:
        state = _state_of(spark, state_table, spec)
        watermark, last_run = current_watermark(state, spec), last_run_at(state, spec)
        # A run that dies leaves its started mark.
        _save_state(staged(watermark_mark_started(state, _one_key(spark, spec), run_ts), "state"), state_table, folder)
        state = _state_of(spark, state_table, spec)
        before = current(spark, target_table)
        seen = table_version(spark, target_table)
        raw = staged(extract(spark, spec, *extraction_window(spec, watermark, run_ts)), spec.name)
        n_before = before.count()
        how = {"co_located": True} if by_bucket(spark, target_table, spec.primary_key) else {"small_batch": True}
        result = run_load(raw, before, state, spec, run_ts, stage=False, **how)
        new_state = staged(result.state, "state")
        if result.status == "success":
            publish(result.target, target_table, f"{folder}/{target_table}", expected=seen)
        _save_state(new_state, state_table, folder)
        target, state = current(spark, target_table), _state_of(spark, state_table, spec)
        counts = result.stats.first()
        batch, _ = prepare_batch(raw, spec, watermark, run_ts)
        return LoadResult(
            target,
            state,
            result.stats,
            result.status,
            run_metadata(batch, counts["pk_missing"], n_before, watermark, spec.incremental_column, run_ts, last_run),
            custom_metadata(target, spec.custom_metadata) if spec.custom_metadata else None,
            table_checks(target, spec, state, run_ts),
        )
    except Exception as error:
        failed = _one_key(spark, spec).withColumns(
            {"status": F.lit("failed"), "error_message": F.lit(str(error))}
        )
        after = watermark_set_status(_state_of(spark, state_table, spec), failed, run_ts)
        _save_state(staged(after, "state"), state_table, folder)
        raise
