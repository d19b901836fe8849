"""Streaming loads. A stream reads everything the given table has, then stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans.load import current, publish
from strata.queries.base import ORACLES, query, table
from strata.queries.inputs import STAGING, events_target, restage
from strata.session import work_dir
from strata.streaming import stream_dedup, stream_insert_new, stream_upsert, table_sink


def _event_stream(spark, d):
    # A pattern is accepted whether the table is one file or a folder of files.
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).parquet(f"{d}/[e]vents.parquet")


def _staging_stream(spark, d):
    """The staging rule of the batch queries, applied to a stream."""
    return restage(_event_stream(spark, d))


@query("stream_upsert", ORACLES["merge_upsert"])
def stream_upsert_(spark, d):
    folder = work_dir(spark, "stream")
    name = f"strata_stream_{folder.rsplit('-', 1)[1]}"
    publish(events_target(spark, d), name, f"{folder}/table")
    sink = table_sink(name, f"{folder}/table", "event_id", "ts")
    stream_upsert(_staging_stream(spark, d), sink, f"{folder}/checkpoint").awaitTermination()
    return current(spark, name)


@query("stream_dedup", f"WITH {STAGING} SELECT DISTINCT event_id, event_type, user_id FROM stg")
def stream_dedup_(spark, d):
    folder = work_dir(spark, "dedup")
    deduped = stream_dedup(_staging_stream(spark, d), "event_id", "ts", spread=F.col("ts"))
    written = (
        deduped.select("event_id", "event_type", "user_id")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
    )
    written.awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


@query("stream_insert_new", f"WITH {STAGING} SELECT event_id, min(ts) AS ts FROM stg GROUP BY event_id")
def stream_insert_new_(spark, d):
    """Several micro-batches, the oldest rows last: each id is written once, by the batch that sees it first."""
    folder = work_dir(spark, "inserted")
    rows = restage(table(spark, d, "events")).select("event_id", "ts")
    late = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for part in (2, 1, 0):
        # Each run of the stream takes what was added since the one before.
        rows.filter(late == part).select("event_id", "ts").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema("event_id bigint, ts timestamp_ntz").parquet(f"{folder}/in")
        stream_insert_new(stream, f"{folder}/out", "event_id", f"{folder}/checkpoint", "ts").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("event_id", "ts")
