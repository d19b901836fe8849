"""The load loop as a stream."""

from strata.streaming.loads import file_sink, partition_sink, stream_dedup, stream_insert_new, stream_upsert, table_sink

__all__ = ["file_sink", "partition_sink", "stream_dedup", "stream_insert_new", "stream_upsert", "table_sink"]
