"""Loading a batch into a target: replace, upsert, copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.time import clock
from strata.operators.align import align_by_name, column_intersect, find_column, widened
from strata.operators.dedup import dedup_latest
from strata.operators.mapping import drop_etl_columns
from strata.operators.sizing import fits_broadcast, key_piece, no_piece, plain_columns
from strata.specs import key_list


def full_refresh(
    target: DataFrame, batch: DataFrame, keys: str | Sequence[str], order_by: str | None = None
) -> DataFrame:
    """The new content of a replaced table: the whole batch, one row per key."""
    return dedup_latest(align_by_name(batch, target.schema), keys, order_by)


def merge_upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: str | Sequence[str],
    order_by: str | None = None,
    insert_only: Sequence[str] = ("inserted_at",),
    new_columns: bool = False,
    small_batch: bool = False,
    co_located: bool = False,
) -> DataFrame:
    """Upsert a batch into a target by primary key and return the new target.

    * The batch is deduplicated first (newest ``order_by`` wins).
    * On a match every common non-key column takes the batch value, NULL included; columns in
      ``insert_only`` and columns the batch lacks keep the target value.
    * A NULL in any key part never matches: such batch rows are inserted. Rows without a key are
      spread over several tasks, so a mass of them cannot pile up in one.
    * ``new_columns`` adds columns only the batch has, NULL for untouched rows.
    * ``small_batch`` asks to join by broadcast, so that the target is not shuffled at all. The batch
      is measured first and joined by shuffle after all if it is too large; it is read several times
      and should be a staged table.
    * ``co_located`` is for a target bucketed by exactly its key (see
      :func:`strata.plans.load.publish`): its buckets are joined as they lie and only the batch moves.

    Keys are unique on both sides of the join, so no join partition can be skewed.
    """
    names = key_list(keys)
    schema = widened(target.schema, batch.schema) if new_columns else target.schema
    old = align_by_name(target, schema) if new_columns else target
    batch = column_intersect(batch, schema)
    lost = [k for k in names if find_column(k, batch.columns) is None]
    if lost:
        raise ValueError(f"target and batch must both have key columns {', '.join(lost)}")
    names = [find_column(k, batch.columns) for k in names]
    # Deduplicated by the join key, the batch is shuffled once for both.
    extra = [] if co_located else ["_piece"]
    for column in extra:
        batch = batch.withColumn(column, no_piece(names))
    new = dedup_latest(batch, [*names, *extra], order_by)

    if small_batch and fits_broadcast(new):
        merged = _broadcast_merge(old, new.drop(*extra), names, insert_only)
    else:
        # The extra join key that spreads rows without a key would not fit the buckets.
        old = old if co_located else old.withColumn("_piece", key_piece(names, plain_columns(old)))
        merged = _shuffle_merge(old, new, [*names, *extra], insert_only)
    return merged.select(*schema.names)


def _merged_column(name: str, in_batch: bool, insert_only: Sequence[str], new_row: Column, old_row: Column) -> Column:
    mine, theirs = F.col(f"t.`{name}`"), F.col(f"s.`{name}`")
    if not in_batch:
        value = mine
    elif name in insert_only:
        value = F.when(old_row, mine).otherwise(theirs)
    else:
        value = F.when(new_row, theirs).otherwise(mine)
    return value.alias(name)


def _same_key(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys]


def _shuffle_merge(old: DataFrame, new: DataFrame, keys: Sequence[str], insert_only: Sequence[str]) -> DataFrame:
    # Presence is a flag of its own: any value column may be NULL in a row that exists.
    t = old.withColumn("_old", F.lit(True)).alias("t")
    s = new.withColumn("_new", F.lit(True)).alias("s")
    joined = t.join(s, _same_key(keys), "full_outer")
    new_row, old_row = F.col("s._new").isNotNull(), F.col("t._old").isNotNull()
    columns = [
        F.coalesce(F.col(f"t.`{c}`"), F.col(f"s.`{c}`")).alias(c)
        if c in keys
        else _merged_column(c, c in new.columns, insert_only, new_row, old_row)
        for c in old.columns
    ]
    return joined.select(*columns)


def _broadcast_merge(old: DataFrame, new: DataFrame, keys: Sequence[str], insert_only: Sequence[str]) -> DataFrame:
    t = old.alias("t")
    s = F.broadcast(new.withColumn("_new", F.lit(True))).alias("s")
    new_row, old_row = F.col("s._new").isNotNull(), F.lit(True)
    columns = [
        F.col(f"t.`{c}`").alias(c)
        if c in keys
        else _merged_column(c, c in new.columns, insert_only, new_row, old_row)
        for c in old.columns
    ]
    updated = t.join(s, _same_key(keys), "left").select(*columns)
    # Matched keys are at most as many as the batch has; only they are compared with the batch.
    matched = old.select(*keys).join(F.broadcast(new.select(*keys)), list(keys), "left_semi")
    added = new.join(matched, list(keys), "left_anti")
    return updated.unionByName(align_by_name(added, old.schema))


def table_backfill(source: DataFrame, run_ts) -> DataFrame:
    """Content of a table copied as is: tool columns dropped, audit columns added where missing."""
    kept = drop_etl_columns(source)
    have = {c.lower() for c in kept.columns}
    stamps = {c: clock(run_ts) for c in ("inserted_at", "updated_at") if c not in have}
    return kept.withColumns(stamps) if stamps else kept
