"""Which keys a folder has been given, told by bitmaps of key hashes before any row is read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import path_exists, remove, subfolders

# Bits of one bitmap, as the bitmap functions have them.
BITMAP = 32_768
# Hidden folder of the bitmaps in the folder of the rows; readers skip it.
BITS = "_bits"


class KeyBits:
    """One bit per key hash. A key whose bit is unset has not been written; one whose bit is set may have been.

    Versions of the bitmaps are whole folders, the newest complete one counts. Bits are written before the rows they stand for, so a run
    that dies leaves bits too many, never too few. With ``bits`` at 16 times the number of keys, one new key in 16 is looked up in vain;
    all bitmaps together take ``bits / 8`` bytes, however many rows there are.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], bits: int):
        self.spark, self.folder, self.keys, self.bits = spark, f"{path.rstrip('/')}/{BITS}", list(keys), bits

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.bits))

    def _versions(self) -> list[str]:
        done = [n for n in subfolders(self.spark, self.folder) if path_exists(self.spark, f"{self.folder}/{n}/_SUCCESS")]
        return sorted(done, key=lambda n: int(n.split("-")[0]))

    def _newest(self) -> DataFrame | None:
        done = self._versions()
        return self.spark.read.parquet(f"{self.folder}/{done[-1]}") if done else None

    def maybe_written(self, rows: DataFrame) -> DataFrame:
        """The rows with ``_maybe``: whether the bit of their key is set."""
        newest = self._newest()
        if newest is None:
            return rows.withColumn("_maybe", F.lit(False))
        slot = self._slot()
        placed = rows.withColumns({"_number": F.floor(slot / BITMAP).cast("bigint"), "_at": (slot % BITMAP).cast("int")})
        byte = F.conv(F.hex(F.substring("_bitmap", (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.floor(byte / F.pow(F.lit(2), F.col("_at") % 8)) % 2 == 1
        known = newest.withColumnsRenamed({"number": "_number", "bitmap": "_bitmap"})
        found = placed.join(known, "_number", "left").withColumn("_maybe", F.coalesce(bit, F.lit(False)))
        return found.select(*rows.columns, "_maybe")

    def add(self, rows: DataFrame, number: int) -> None:
        """Set the bits of the rows' keys, as a new version; older ones than the one before go."""
        slot = self._slot()
        new = rows.groupBy(F.floor(slot / BITMAP).cast("bigint").alias("number")).agg(F.bitmap_construct_agg(slot % BITMAP).alias("bitmap"))
        old, before = self._newest(), self._versions()
        whole = new if old is None else old.unionByName(new).groupBy("number").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        whole.write.parquet(f"{self.folder}/{number:09d}-{uuid.uuid4().hex}")
        for name in before[:-1]:
            remove(self.spark, f"{self.folder}/{name}")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Part of the key space that rows are stored by."""
    return F.pmod(F.xxhash64(F.lit("bucket"), *[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def written_rows(spark: SparkSession, path: str, keys: Sequence[str], number: int, buckets: Sequence[int]) -> DataFrame:
    """The keys that earlier batches put into some buckets; other buckets' files are not read."""
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.filter(F.col("_bucket").isin(*buckets) & (F.col("_batch") < number)).select(*keys)
