"""Joins from facts to dimensions and from entities to their aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import any_null
from strata.operators.sizing import fits_broadcast, hot_keys, input_piece, key_piece, no_piece, pieces_of, plain_columns, small_side
from strata.specs import key_list

def left_lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str],
    hot: DataFrame | None = None,
    broadcast_bytes: int | None = None,
    hot_rows: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add dimension columns to facts; facts without a match keep NULLs.

    A dimension that measures small is broadcast. A larger one is joined by shuffle, where facts of
    hot keys and facts without a key are spread over pieces; only the dimension rows of hot keys
    are copied to every piece of their key. ``hot`` is a result of
    :func:`strata.operators.sizing.hot_keys` if it is known; otherwise the facts are counted by key,
    or ``counted`` in their place: a narrow table with the same keys, if the facts are themselves the result of joins.
    """
    names = key_list(keys)
    side = dim.select(*names, *columns)
    if fits_broadcast(side, broadcast_bytes):
        return facts.join(F.broadcast(side), names, "left").select(*facts.columns, *columns)

    if hot is None:
        rows = counted if counted is not None and set(names) <= set(counted.columns) else facts
        hot = hot_keys(rows.filter(~any_null(names)), names, hot_rows)
    if hot is None:
        spread = facts.withColumn("_piece", key_piece(names, plain_columns(facts)))
        copies = side.withColumn("_piece", F.lit(0))
    else:
        cut = small_side(hot.select(*names, pieces_of(F.col("n_rows"), hot_rows).alias("_pieces")))
        piece = F.pmod(input_piece(plain_columns(facts)), F.col("_pieces"))
        spread = facts.join(cut, names, "left").withColumn(
            "_piece", F.when(F.col("_pieces").isNotNull(), piece).otherwise(key_piece(names, plain_columns(facts)))
        )
        last = F.coalesce(F.col("_pieces"), F.lit(1)) - 1
        copies = side.join(cut, names, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), last)))
    return (
        spread.join(copies.drop("_pieces"), [*names, "_piece"], "left").select(*facts.columns, *columns)
    )


def left_join_agg(
    entities: DataFrame, details: DataFrame, keys: str | Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    """Entities with aggregates of their details; entities without details keep NULLs.

    The details are aggregated before the join, so it moves one row per key. Entities without a key are spread.
    """
    names = key_list(keys)
    spread = entities.withColumn("_piece", key_piece(names, plain_columns(entities)))
    grouped = details.groupBy(*names).agg(*aggregates).withColumn("_piece", no_piece(names))
    return spread.join(grouped, [*names, "_piece"], "left").drop("_piece")


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent and how many rows use them; NULL keys are ignored."""
    used = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("n_rows"))
    return used.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
