"""Size and skew measurements that decide between physical strategies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import any_null
from strata.session import staged

# A side is broadcast only when its measured size is at most this.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with this many rows is hot: one task should not have to handle all of them.
HOT_ROWS = 10_000_000
# Rows of a hot key that one task gets.
PIECE_ROWS = 2_000_000


def row_bytes(schema: T.StructType) -> Column:
    """Approximate width of a row in memory: measured for variable-length values, 16 bytes otherwise."""
    width = F.lit(0).cast("bigint")
    for f in schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            size = F.octet_length(c)
        elif isinstance(f.dataType, T.BinaryType):
            size = F.length(c)
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            size = F.octet_length(F.to_json(c))
        else:
            size = F.lit(0)
        width = width + F.coalesce(size, F.lit(0)) + 16
    return width


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Measure ``df`` with one aggregate and compare it with the broadcast bound."""
    limit = BROADCAST_BYTES if max_bytes is None else max_bytes
    size = df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0
    return size <= limit


def small_side(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it fits, unmarked otherwise."""
    return F.broadcast(df) if fits_broadcast(df) else df


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> DataFrame | None:
    """Keys (NULL included) with at least ``min_rows`` rows and their counts; None if there are none.

    One pass over the key columns, counted before the shuffle; a second one only if there are hot
    keys. The result has at most ``rows / min_rows`` rows and is kept as a staged table.
    """
    least = HOT_ROWS if min_rows is None else min_rows
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    if (counts.agg(F.max("n_rows")).first()[0] or 0) < least:
        return None
    return staged(counts.filter(F.col("n_rows") >= least), "hot")


def pieces_of(n_rows: Column, piece_rows: int | None = None) -> Column:
    """How many pieces a key with so many rows is cut into."""
    return F.ceil(n_rows / F.lit(PIECE_ROWS if piece_rows is None else piece_rows)).cast("int")


def input_piece(columns: Sequence[str] = ()) -> Column:
    """A number that tells rows of one key apart, and that a repeated task gives again.

    It mixes the row's other columns with its input partition: equal rows differ by where they lie, and rows that lie
    together, say in a file sorted by the key, differ by what they hold.
    """
    values = [F.col(f"`{c}`") for c in columns]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *values), F.lit(2**31 - 1)).cast("int")


def plain_columns(df: DataFrame) -> list[str]:
    """Columns that can be hashed as they are."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return [f.name for f in df.schema if not isinstance(f.dataType, nested)]


def key_piece(keys: Sequence[str], columns: Sequence[str] = ()) -> Column:
    """An extra join key: 0 for rows with a key, spread values for rows without one, which match nothing."""
    return F.when(any_null(keys), input_piece(columns) + 1).otherwise(0)


def no_piece(keys: Sequence[str]) -> Column:
    """The extra join key of a side with one row per key: always 0.

    It is computed from the key because a plain literal would be optimised away, and with it the
    chance that a deduplication by (key, piece) leaves the rows where the join wants them.
    """
    return F.pmod(F.hash(*keys), F.lit(1))
