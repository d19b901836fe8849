"""Streaming upsert and streaming deduplication."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.keys import any_null
from strata.operators.dedup import top_per_key
from strata.operators.merge import merge_upsert
from strata.operators.sizing import plain_columns
from strata.plans.load import by_bucket, current, drop_versions, merge_files, merge_partitions, publish
from strata.session import Workspace
from strata.specs import key_list
from strata.streaming.keyset import KeyBits, bucket_of, written_rows


# Writes one micro-batch into a target.
Sink = Callable[[DataFrame], None]


def table_sink(table: str, folder: str, keys: str | Sequence[str], order_by: str | None = None, keep: int | None = None) -> Sink:
    """Upsert into a catalog table by publishing a new version of it.

    A table that is bucketed by the keys is joined bucket by bucket, and only the batch moves. ``keep`` removes older
    versions than so many before the current one, once a new one is published; without it all stay.
    """

    def upsert(batch: DataFrame) -> None:
        spark = batch.sparkSession
        publish(merge_upsert(current(spark, table), batch, keys, order_by, co_located=by_bucket(spark, table, keys)), table, folder)
        if keep is not None:
            drop_versions(spark, table, folder, keep)

    return upsert


def file_sink(path: str, keys: str | Sequence[str], order_by: str | None = None) -> Sink:
    """Upsert into an unpartitioned parquet folder, rewriting only the files that hold keys of the batch."""

    def upsert(batch: DataFrame) -> None:
        merge_files(batch.sparkSession, path, batch, keys, order_by)

    return upsert


def partition_sink(path: str, keys: str | Sequence[str], partition_by: str, order_by: str | None = None) -> Sink:
    """Upsert into a partitioned parquet table, rewriting the touched partitions only."""

    def upsert(batch: DataFrame) -> None:
        merge_partitions(batch.sparkSession, path, batch, keys, partition_by, order_by)

    return upsert


def stream_upsert(stream: DataFrame, sink: Sink, checkpoint: str) -> StreamingQuery:
    """Upsert everything a stream has to offer, then stop.

    The checkpoint remembers what was read. A batch that is replayed after a failure gives the same
    table again, because an upsert of the same rows changes nothing.
    """

    def load(batch: DataFrame, _id: int) -> None:
        if not batch.isEmpty():
            sink(batch)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_insert_new(
    stream: DataFrame,
    path: str,
    keys: str | Sequence[str],
    checkpoint: str,
    order_by: str | None = None,
    buckets: int = 64,
    bits: int = 1 << 27,
) -> StreamingQuery:
    """Append the first row of every key that the folder does not have yet, however late it comes; then stop.

    Each micro-batch is reduced to one row per key (the smallest ``order_by``). Keys whose bit is unset in the folder's bitmaps (see
    :class:`strata.streaming.keyset.KeyBits`) are new without a look at any row. The others are compared with the keys
    written before, in their ``buckets`` of the key space only, so a batch of new keys costs what it holds and not what the
    folder has. New rows go into a partition of their batch, by bucket; a batch that is replayed replaces its partition. Rows without a
    key are all new.
    """
    names = key_list(keys)

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        order = [F.col(order_by).asc_nulls_last()] if order_by else []
        rest = [F.col(f"`{c}`").asc_nulls_last() for c in plain_columns(batch) if c not in names]
        known = KeyBits(spark, path, names, bits)
        with Workspace(spark, "insert") as work:
            # Rows that are all key are alike.
            first = top_per_key(batch.filter(~any_null(names)), names, [*order, *rest] or [F.lit(0).asc()])
            rows = work.stage(known.maybe_written(first.withColumn("_bucket", bucket_of(names, buckets))))
            doubtful = rows.filter("_maybe")
            touched = [r[0] for r in doubtful.select("_bucket").distinct().collect()]
            new = rows.filter(~F.col("_maybe"))
            if touched:
                new = new.unionByName(doubtful.join(written_rows(spark, path, names, number, touched), names, "left_anti"))
            new = work.stage(new.select(*rows.columns).drop("_maybe"))
            known.add(new, number)
            new = new.unionByName(batch.filter(any_null(names)).withColumn("_bucket", F.lit(buckets)))
            new.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path.rstrip('/')}/_batch={number}")

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedup(
    stream: DataFrame,
    keys: str | Sequence[str],
    event_time: str,
    lookback: str = "3 days",
    spread: Column | None = None,
) -> DataFrame:
    """First row per key within the lookback; later rows are dropped (see :func:`stream_insert_new` for those).

    ``spread`` (say, a hash of the input file) splits the copies of a key over several tasks that
    each let one through before the final pass, for streams in which one key dominates.
    """
    names = key_list(keys)
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, lookback)
    if spread is not None:
        # As many pieces as the stream has shuffle partitions, which a cluster sizes for its data.
        salts = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        piece = F.pmod(F.xxhash64(spread), F.lit(salts)).alias("_piece")
        timed = timed.select("*", piece).dropDuplicatesWithinWatermark([*names, "_piece"]).drop("_piece")
    return timed.dropDuplicatesWithinWatermark(names)
