"""Slowly changing history: snapshots, bulk history from a change log, point-in-time joins.

A history row is valid in the half-open interval ``[valid_from, valid_to)``; NULL ``valid_to``
means it still is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.keys import any_null
from strata.functions.time import clock, wall_micros
from strata.operators.dedup import dedup_latest
from strata.operators.sizing import PIECE_ROWS, hot_keys, input_piece, key_piece, no_piece, pieces_of, plain_columns, small_side
from strata.session import staged
from strata.specs import key_list

def first_snapshot(source: DataFrame, valid_from: Column) -> DataFrame:
    """Every row of the source as an open version."""
    return source.withColumns(
        {"valid_from": valid_from.cast("timestamp_ntz"), "valid_to": F.lit(None).cast("timestamp_ntz")}
    )


def snapshot_timestamp(
    history: DataFrame | None,
    source: DataFrame,
    keys: str | Sequence[str],
    updated_at: str,
    run_ts,
    hard_deletes: bool = False,
) -> DataFrame:
    """History after one more look at the source; a row changed when its ``updated_at`` is newer.

    The old version closes and the new one opens at the source's ``updated_at``.
    """
    opened = F.col(updated_at).cast("timestamp_ntz")
    changed = F.col(f"s.`{updated_at}`").cast("timestamp_ntz") > F.col("h.valid_from")
    return _snapshot(history, source, keys, updated_at, opened, changed, run_ts, hard_deletes)


def snapshot_check(
    history: DataFrame | None,
    source: DataFrame,
    keys: str | Sequence[str],
    check_columns: Sequence[str] | None,
    run_ts,
    hard_deletes: bool = False,
) -> DataFrame:
    """History after one more look at the source; a row changed when any check column differs.

    NULL counts as a value. Without ``check_columns`` every non-key column is checked.
    """
    names = key_list(keys)
    columns = check_columns or [c for c in source.columns if c not in names]
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"h.`{c}`").eqNullSafe(F.col(f"s.`{c}`"))
    return _snapshot(history, source, keys, None, clock(run_ts), changed, run_ts, hard_deletes)


def _snapshot(history, source, keys, order_by, opened, changed, run_ts, hard_deletes) -> DataFrame:
    names = key_list(keys)
    latest = dedup_latest(source.withColumn("_piece", no_piece(names)), [*names, "_piece"], order_by)
    if history is None:
        return first_snapshot(latest.drop("_piece"), opened)
    added = [f for f in source.schema if f.name not in history.columns]
    history = history.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added}) if added else history

    # Closed versions cannot change any more: they bypass the join.
    settled = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())

    # A version or a source row without a key matches nothing: the version stays as it is, and each
    # look at the source opens the row anew.
    h = current.withColumns({"_old": F.lit(True), "_piece": key_piece(names, plain_columns(current))}).alias("h")
    s = latest.withColumns({"_opened": opened, "_new": F.lit(True)}).alias("s")
    joined = h.join(s, [F.col(f"h.`{k}`") == F.col(f"s.`{k}`") for k in [*names, "_piece"]], "full_outer")

    in_history, in_source = F.col("h._old").isNotNull(), F.col("s._new").isNotNull()
    keyed = ~any_null([F.col(f"h.`{k}`") for k in names])
    replaced = in_history & in_source & changed
    gone = in_history & ~in_source & keyed if hard_deletes else F.lit(False)
    attributes = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    stays = F.struct(
        *[F.col(f"h.`{c}`").alias(c) for c in attributes],
        F.col("h.valid_from").alias("valid_from"),
        F.when(replaced, F.col("s._opened")).when(gone, clock(run_ts)).alias("valid_to"),
    )
    opens = F.struct(
        *[(F.col(f"s.`{c}`") if c in latest.columns else F.lit(None)).alias(c) for c in attributes],
        F.col("s._opened").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    # One joined row gives the old version, the new version or both.
    versions = F.array(F.when(in_history, stays), F.when(in_source & (~in_history | replaced), opens))
    moved = joined.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select("v.*")
    return settled.unionByName(moved).select(*history.columns)


@dataclass(frozen=True)
class TimeSlices:
    """How the rows of hot keys are cut along time.

    ``edges``: per hot key the first microsecond, the width and number of its equal steps in time,
    and its last slice. ``steps``: per hot key and step its first slice; thin neighbouring steps
    share a slice, and a step with more rows than a slice is cut again between the first and the
    last time that occurs in it, so a burst is spread as well.
    """

    keys: tuple[str, ...]
    edges: DataFrame
    steps: DataFrame


# Steps a slice is put together from, on average.
STEPS_PER_SLICE = 4


def time_slices(
    parts: Sequence[tuple[DataFrame, str]],
    keys: str | Sequence[str],
    hot_rows: int | None = None,
    slice_rows: int | None = None,
) -> TimeSlices | None:
    """Cut hot keys along time; None if no key is hot. ``parts`` are (rows, time column).

    The number of slices grows with the number of rows, so a slice keeps a size that one task can
    sort. Everything returned is small: about ``STEPS_PER_SLICE`` rows per slice.
    """
    names = key_list(keys)
    size = PIECE_ROWS if slice_rows is None else slice_rows
    rows = None
    for df, time in parts:
        part = df.select(*names, wall_micros(time).alias("_t"))
        rows = part if rows is None else rows.unionByName(part)
    hot = hot_keys(rows, names, hot_rows)
    if hot is None:
        return None

    picked = _on_keys(rows, small_side(hot), names, "inner").filter(F.col("_t").isNotNull())
    n_steps = pieces_of(F.count("*"), size) * STEPS_PER_SLICE
    span = F.max("_t") - F.min("_t") + 1
    edges = staged(
        picked.groupBy(*names).agg(
            F.min("_t").alias("_low"), F.ceil(span / n_steps).alias("_width"), (n_steps - 1).alias("_last_step")
        ),
        "edges",
    )
    side = small_side(edges)
    counts = (
        _on_keys(picked.select(*names, "_t"), side, names, "inner")
        .withColumn("_step", _step(F.col("_t")))
        .groupBy(*names, "_step")
        .agg(F.count("*").alias("_n"), F.min("_t").alias("_from"), F.max("_t").alias("_to"))
    )
    every = edges.select(*names, F.explode(F.sequence(F.lit(0), F.col("_last_step"))).alias("_step"))
    before = Window.partitionBy(*names).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    cuts = F.coalesce(pieces_of(F.col("_n"), size), F.lit(1))
    steps = staged(
        _on_keys(every, counts, [*names, "_step"], "left").select(
            *names,
            "_step",
            F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / size).cast("int").alias("_slice"),
            F.coalesce("_from", F.lit(0)).alias("_from"),
            F.coalesce(F.ceil((F.col("_to") - F.col("_from") + 1) / cuts), F.lit(1)).alias("_cut_width"),
            (cuts - 1).alias("_last_cut"),
        ),
        "steps",
    )
    last = steps.groupBy(*names).agg(F.max(F.col("_slice") + F.col("_last_cut")).alias("_last_slice"))
    located = staged(_on_keys(edges, last, names, "left"), "edges")
    return TimeSlices(tuple(names), small_side(located), small_side(steps))


def _on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL; the right side's other columns are added."""
    renamed = right.withColumnsRenamed({k: f"_right_{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_right_{i}"))
    return left.join(renamed, same, how).drop(*[f"_right_{i}" for i in range(len(keys))])


def _step(micros: Column) -> Column:
    """The step of a time on a row that carries its key's edges."""
    return _part(micros, "_low", "_width", "_last_step")


def _part(micros: Column, low: str, width: str, last: str) -> Column:
    """Which of several equal parts of a range a value lies in; outer values belong to the outer parts."""
    n = F.floor((micros - F.col(low)) / F.col(width))
    return F.greatest(F.lit(0), F.least(n, F.col(last))).cast("int")


def _with_edges(df: DataFrame, slices: TimeSlices) -> DataFrame:
    return _on_keys(df, slices.edges, slices.keys, "left")


def _with_slice(df: DataFrame, time: Column, slices: TimeSlices, name: str) -> DataFrame:
    """Number of the time slice on rows that carry their key's edges; 0 for ordinary keys and NULL times."""
    located = df.withColumn("_at_step", _step(wall_micros(time)))
    steps = slices.steps.withColumnsRenamed({"_step": "_at_step", "_slice": "_base"})
    found = _on_keys(located, steps, [*slices.keys, "_at_step"], "left")
    cut = _part(wall_micros(time), "_from", "_cut_width", "_last_cut")
    return found.withColumn(name, F.coalesce(F.col("_base") + cut, F.lit(0))).drop(
        "_at_step", "_base", "_from", "_cut_width", "_last_cut"
    )


EDGE_COLUMNS = ("_low", "_width", "_last_step", "_last_slice")
# Stands for "measure the input" where slices may also be None.
MEASURE = object()


def bulk_history(
    log: DataFrame,
    keys: str | Sequence[str],
    updated_at: str,
    order_by: Sequence[str] = (),
    slices: TimeSlices | None | object = MEASURE,
) -> DataFrame:
    """Full history from a change log: each version ends where the next one of its key begins.

    Several changes of a key at one time leave one version, the first by ``order_by`` descending.
    Hot keys are worked on slice by slice. ``slices`` takes a result of :func:`time_slices`; None
    promises that no key is hot.
    """
    names = key_list(keys)
    if slices is MEASURE:
        slices = time_slices([(log, updated_at)], names)
    versions = dedup_latest(log, [*names, updated_at], list(order_by)).withColumn(
        "valid_from", F.col(updated_at).cast("timestamp_ntz")
    )
    if slices is None:
        by_time = Window.partitionBy(*names).orderBy("valid_from")
        return versions.withColumn("valid_to", F.lead("valid_from").over(by_time))

    sliced = _with_slice(_with_edges(versions, slices), F.col("valid_from"), slices, "_slice")
    in_slice = Window.partitionBy(*names, "_slice").orderBy("valid_from")
    # The last version of a slice ends with the first one of the key's next slice. Only hot keys
    # have a next slice, so this lookup has one row per slice of a hot key.
    hot = _on_keys(log.select(*names, F.col(updated_at).cast("timestamp_ntz").alias("_t")), slices.edges, names, "inner")
    starts = (
        _with_slice(hot, F.col("_t"), slices, "_slice").groupBy(*names, "_slice").agg(F.min("_t").alias("_start"))
    )
    by_slice = Window.partitionBy(*names).orderBy("_slice")
    following = staged(
        starts.select(*names, "_slice", F.lead("_start").over(by_slice).alias("_next")).filter("_next IS NOT NULL"),
        "slices",
    )
    ended = sliced.withColumn("valid_to", F.lead("valid_from").over(in_slice))
    return (
        _on_keys(ended, small_side(following), [*names, "_slice"], "left")
        .withColumn("valid_to", F.coalesce("valid_to", "_next"))
        .select(*versions.columns, "valid_to")
    )


def asof_join(
    facts: DataFrame,
    history: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    attributes: Sequence[str],
    slices: TimeSlices | None | object = MEASURE,
) -> DataFrame:
    """Left join of facts to the version valid at their time: ``valid_from <= ts < valid_to``.

    Versions of a key must not overlap. Facts and versions are stacked and sorted once by key and
    time, and each fact takes the last version before it, so the work is linear even where a key has
    many facts and many versions. A hot key is cut into time slices; a version that spans several
    slices is placed in each of them. ``slices`` takes a result of :func:`time_slices`; None promises
    that no key is hot.
    """
    names = key_list(keys)
    if slices is MEASURE:
        matchable = facts.filter(~any_null(names))
        slices = time_slices([(matchable, ts), (history.filter(~any_null(names)), "valid_from")], names)
    loose = any_null(names) | F.col(ts).isNull()
    at = F.col(ts).cast("timestamp_ntz")
    start, stop = F.col("valid_from").cast("timestamp_ntz"), F.col("valid_to").cast("timestamp_ntz")

    left, spans = facts, history.filter(~any_null(names))
    if slices is None:
        left, spans = left.withColumn("_slice", F.lit(0)), spans.withColumn("_slice", F.lit(0))
    else:
        left = _with_slice(_with_edges(left, slices), at, slices, "_slice").drop(*EDGE_COLUMNS)
        spans = _with_slice(_with_edges(spans, slices), start, slices, "_first")
        spans = _with_slice(spans, stop, slices, "_end")
        until = F.when(stop.isNull(), F.coalesce("_last_slice", F.lit(0))).otherwise(F.col("_end"))
        spans = spans.withColumn("_slice", F.explode(F.sequence(F.col("_first"), F.greatest("_first", until))))
    # Facts without a key or a time match nothing; negative slices hold no versions.
    part = F.when(loose, -1 - input_piece(plain_columns(facts))).otherwise(F.col("_slice"))
    left = left.withColumns({"_slice": part, "_at": at, "_kind": F.lit(1)})
    version = F.struct(*attributes, stop.alias("valid_to")).alias("_version")
    right = spans.select(*names, "_slice", start.alias("_at"), F.lit(0).alias("_kind"), version)

    # At equal times the version comes first, so it is already valid for the fact.
    running = (
        Window.partitionBy(*names, "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    )
    stacked = left.unionByName(right, allowMissingColumns=True)
    seen = F.last("_version", ignorenulls=True).over(running)
    matched = stacked.withColumn("_seen", seen).filter(F.col("_kind") == 1)
    valid = F.col("_seen.valid_to").isNull() | (F.col("_at") < F.col("_seen.valid_to"))
    return matched.select(*facts.columns, *[F.when(valid, F.col(f"_seen.`{a}`")).alias(a) for a in attributes])


def dim_scd1(source: DataFrame, keys: str | Sequence[str], columns: Sequence[str], order_by: str) -> DataFrame:
    """Current-state dimension: newest row per key, declared columns only."""
    return dedup_latest(source, keys, order_by).select(*columns)
