"""Exact deduplication by skew-safe combining."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, content, fresh, without
from strata.session import Workspace, kept

OUT = ("keep_id", "group_size", "kept")
# A text is hot if more than one row in so many has it; there are fewer hot texts than this.
HOT_SHARE = 1000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def exact_dedup(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    salts: int = 64,
    hot_share: int = HOT_SHARE,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """All rows with ``keep_id`` (largest id among equal texts), ``group_size`` and ``kept``.

    Rows are combined in three steps, and every step groups by the full text beside its digest, so
    equal digests of different texts never meet: within each map task; among the salted pieces of a
    hot text (any other text has one piece); and across the pieces. What the rows then get back is
    narrow. Hot texts, fewer than ``hot_share`` by definition, answer their rows by broadcast, and
    the rows of any other text are at most one in ``hot_share``.

    NULL text counts as empty. Rows that repeat an id and a text count in ``group_size`` and share
    one verdict. A NULL id is kept only if its whole group has none. Columns of the input named like an added one are replaced.
    """
    spark = docs.sparkSession
    docs = without(docs, OUT)
    key, body, piece, size, keep, hot_size, hot_keep, join_key = fresh(
        docs, "key", "body", "piece", "size", "keep", "hot_size", "hot_keep", "join_key"
    )
    rows = docs.withColumn(body, content(text)).withColumn(key, digest(F.col(body)))
    with Workspace(spark, "exact") as work:
        narrow = work.stage(rows.select(col(id).alias(keep), key))
        total = narrow.count()
        hot = narrow.groupBy(key).count().filter(F.col("count") * hot_share > total).select(key, F.lit(True).alias(size))
        pieces = (
            rows.select(col(id).alias(keep), key, body)
            .join(F.broadcast(hot), key, "left")
            .withColumn(piece, F.when(F.col(size), F.pmod(F.spark_partition_id(), F.lit(salts))))
            .groupBy(key, piece, body)
            .agg(F.max(keep).alias(keep), F.count("*").alias(size))
        )
        pieces = work.stage(
            pieces.select(key, keep, size, F.when(F.col(piece).isNotNull(), F.col(body)).alias(body))
        )
        cold = pieces.filter(F.col(body).isNull()).select(key, keep, size)
        merged = pieces.filter(F.col(body).isNotNull()).groupBy(key, body).agg(F.max(keep).alias(keep), F.sum(size).alias(size))
        groups = work.stage(cold.unionByName(merged.select(key, keep, size)))
        shared = groups.groupBy(key).count().filter(F.col("count") > 1).select(key)
        collided = not shared.isEmpty()
        if collided:
            mixed = kept(
                rows.join(shared, key, "left_semi").groupBy(key, body).agg(F.max(col(id)).alias(keep), F.count("*").alias(size))
            )
            groups = groups.join(shared, key, "left_anti")
        groups = kept(groups)
    few = groups.filter(F.col(size) * hot_share > total).select(key, F.col(size).alias(hot_size), F.col(keep).alias(hot_keep))
    many = groups.filter(F.col(size) * hot_share <= total).withColumnRenamed(key, join_key)
    # Rows that are answered already spread over all partitions by a key of another length.
    out = (
        rows.join(F.broadcast(few), key, "left")
        .withColumn(
            join_key,
            F.when(F.col(hot_size).isNotNull(), F.unhex(F.lpad(F.hex(F.xxhash64(col(id), key)), 16, "0"))).otherwise(F.col(key)),
        )
        .join(many, join_key, "left")
        .withColumn(size, F.coalesce(hot_size, size))
        .withColumn(keep, F.when(F.col(hot_size).isNotNull(), F.col(hot_keep)).otherwise(F.col(keep)))
    )
    if collided:
        names = [*docs.columns, key, body]
        clean = out.filter(F.col(size).isNotNull())
        rest = rows.join(shared_keys(mixed, key), key, "left_semi")
        again = rest.join(mixed.withColumnRenamed(key, join_key).withColumnRenamed(body, piece), (F.col(key) == F.col(join_key)) & (F.col(body) == F.col(piece)))
        both = [*[col(c) for c in names], F.col(size), F.col(keep)]
        out = clean.select(*both).unionByName(again.select(*both))
    return out.select(
        *[col(c) for c in docs.columns],
        F.col(keep).alias("keep_id"),
        F.col(size).alias("group_size"),
        col(id).eqNullSafe(F.col(keep)).alias("kept"),
    )


def shared_keys(mixed: DataFrame, key: str) -> DataFrame:
    return mixed.select(key).distinct()
