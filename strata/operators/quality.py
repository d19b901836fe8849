"""Data checks. Every check is an aggregate that yields (check_name, severity, passed, metric, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import any_missing, any_null
from strata.functions.time import clock, hours_between
from strata.operators.aggregates import dup_groups
from strata.operators.align import missing_columns
from strata.operators.joins import fk_orphans
from strata.operators.watermarks import STATE_KEY
from strata.specs import LoadSpec, key_list

ERROR, WARN = "ERROR", "WARN"


class CheckFailed(Exception):
    """At least one ERROR check did not pass."""


def _result(name: str, severity: str, passed: Column, metric: str, value: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(severity).alias("severity"),
        passed.alias("passed"),
        F.lit(metric).alias("metric"),
        value.cast("string").alias("value"),
    )


def _rows(df: DataFrame, results: Sequence[Column]) -> DataFrame:
    return df.agg(F.array(*results).alias("r")).select(F.inline("r"))


@dataclass(frozen=True)
class ColumnCheck:
    """A check that is one aggregate over the table; several of them share one scan."""

    name: str
    metric: str
    value: Column
    passed: Column
    severity: str = ERROR

    def result(self) -> Column:
        return _result(self.name, self.severity, self.passed, self.metric, self.value)


def counted(name: str, metric: str, bad: Column, severity: str = ERROR) -> ColumnCheck:
    """A check that passes when no row is bad."""
    n = F.count_if(bad)
    return ColumnCheck(name, metric, n, n == 0, severity)


def zero_rows(name: str = "zero_rows", skip: bool = False) -> ColumnCheck:
    """The table has rows; can be switched off."""
    n = F.count("*")
    return ColumnCheck(name, "row_count", n, F.lit(True) | (n > 0) if skip else n > 0)


def null_pk(keys: str | Sequence[str], name: str = "null_pk") -> ColumnCheck:
    """No key part is NULL."""
    return counted(name, "null_pk_count", any_null(key_list(keys)))


def not_null(column: str) -> ColumnCheck:
    return counted(f"not_null_{column}", "null_count", F.col(column).isNull())


def accepted_values(column: str, values: Sequence) -> ColumnCheck:
    """Values come from a list; NULL passes."""
    return counted(f"accepted_values_{column}", "rejected_count", ~F.col(column).isin(*values))


def matches(column: str, pattern: str) -> ColumnCheck:
    """Text matches a regular expression; NULL passes."""
    return counted(f"regex_{column}", "unmatched_count", ~F.col(column).rlike(pattern))


def row_count_between(low: int, high: int) -> ColumnCheck:
    n = F.count("*")
    return ColumnCheck("row_count_between", "row_count", n, n.between(low, high))


def run_checks(df: DataFrame, checks: Sequence[ColumnCheck]) -> DataFrame:
    """All checks in one aggregation over one scan."""
    return _rows(df, [c.result() for c in checks])


def check_duplicates(df: DataFrame, keys: str | Sequence[str], name: str = "duplicate_pk") -> DataFrame:
    """No key occurs twice; reports the true number of duplicated keys."""
    n = F.count("*")
    return _rows(dup_groups(df, keys), [_result(name, ERROR, n == 0, "duplicate_pk_groups", n)])


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """No value occurs twice; NULL is not a value."""
    n = F.count("*")
    dups = dup_groups(df.filter(F.col(column).isNotNull()), column)
    return _rows(dups, [_result(f"unique_{column}", ERROR, n == 0, "duplicate_count", n)])


def check_relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Every foreign key has a parent; NULL keys are ignored."""
    n = F.coalesce(F.sum("n_rows"), F.lit(0))
    orphans = fk_orphans(child, fk, parent, pk)
    return _rows(orphans, [_result(f"relationships_{fk}", ERROR, n == 0, "orphan_count", n)])


def check_schema(df: DataFrame, expected: Sequence[str], name: str = "schema") -> DataFrame:
    """All mapped columns exist in the table, in any spelling."""
    absent, present = missing_columns(df, expected)
    found = f"missing: {', '.join(absent) or 'none'}; expected {len(set(expected))}, found {len(present)}"
    value = F.lit(found if expected else "no mapped columns")
    one = df.sparkSession.range(1)  # the answer is in the schema: no row of the table is read
    return _rows(one, [_result(name, WARN, F.lit(not absent), "missing_columns", value)])


def check_freshness(state: DataFrame, as_of, max_hours: int | Column) -> DataFrame:
    """Hours since the last success of every table in the state table; no history passes."""
    limit = max_hours if isinstance(max_hours, Column) else F.lit(max_hours)
    hours = hours_between(clock(as_of), "last_success_at")
    return state.select(
        F.concat(F.col(STATE_KEY[2]), F.lit("_freshness")).alias("check_name"),
        F.lit(WARN).alias("severity"),
        F.coalesce(hours <= limit, F.lit(True)).alias("passed"),
        F.lit("hours_since_last_success").alias("metric"),
        F.round(hours, 1).cast("string").alias("value"),
    )


def source_freshness(df: DataFrame, loaded_at: str, as_of, warn_hours: int, error_hours: int) -> DataFrame:
    """Age of the newest row against a warn and an error limit; an empty source is an error."""
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = hours_between(clock(as_of), F.col("max_loaded_at").cast("timestamp_ntz"))
    status = F.when(age.isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass")
    return newest.select("max_loaded_at", F.round(age, 4).alias("age_hours"), status.alias("status"))


def _present(df: DataFrame, columns: Sequence[str], alias: str) -> DataFrame:
    counts = [F.struct(F.lit(c).alias("column_name"), F.count(F.col(f"`{c}`")).alias(alias)) for c in columns]
    return df.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def null_column_integrity(target: DataFrame, source: DataFrame) -> DataFrame:
    """Columns that are NULL throughout the target must be so in the source as well."""
    shared = [c for c in target.columns if c in source.columns]
    empty = _present(target, target.columns, "target_present").filter("target_present = 0")
    filled = _present(source, shared, "source_present")
    found = F.coalesce("source_present", F.lit(0))
    return empty.join(F.broadcast(filled), "column_name", "left").select(
        "column_name", found.alias("source_present"), F.when(found == 0, "PASS").otherwise("FAIL").alias("status")
    )


def load_stats(
    df: DataFrame,
    keys: str | Sequence[str],
    watermark_column: str | None = None,
    watermark=None,
    rejected: Mapping[str, int] | None = None,
) -> DataFrame:
    """Raw, key-less, mapped and already loaded row counts of a batch, in one pass.

    ``rejected`` holds what was counted while the batch was read from files: ``malformed`` lines, which are raw rows too, and
    ``wrong:<column>`` values that don't fit; they make the columns ``malformed`` and ``wrong_values``.
    """
    missing = any_missing(key_list(keys))
    old = F.lit(False)
    if watermark_column and watermark is not None:
        bound = F.lit(str(watermark)).cast(df.schema[watermark_column].dataType)
        old = F.coalesce(F.col(watermark_column) <= bound, F.lit(False))
    malformed = F.lit((rejected or {}).get("malformed", 0)).cast("bigint")
    stats = df.agg(
        (F.count("*") + malformed).alias("total_raw"),
        F.count_if(missing).alias("pk_missing"),
        F.count_if(~missing).alias("mapped"),
        F.count_if(~missing & old).alias("watermark_skipped"),
    )
    if rejected is None:
        return stats
    wrong = [x for k, n in sorted(rejected.items()) if k.startswith("wrong:") for x in (F.lit(k[6:]), F.lit(n).cast("bigint"))]
    values = F.create_map(*wrong) if wrong else F.create_map()
    return stats.withColumns({"malformed": malformed, "wrong_values": values.cast("map<string,bigint>")})


def table_checks(df: DataFrame, spec: LoadSpec, state: DataFrame, as_of) -> DataFrame:
    """The five standing checks of a loaded table; those of its rows share one scan, grouped by key."""
    keys = list(spec.primary_key)
    # Counted by key, the rows, those without a key and the repeated keys all follow.
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows, lost, twice = F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.when(any_null(keys), F.col("_n"))), F.lit(0)), F.count_if(F.col("_n") > 1)
    filled = F.lit(True) | (rows > 0) if spec.skip_zero_rows_check else rows > 0
    checks = [
        replace(zero_rows(f"{spec.name}_zero_rows"), value=rows, passed=filled),
        replace(null_pk(keys, f"{spec.name}_null_pk"), value=lost, passed=lost == 0),
        ColumnCheck(f"{spec.name}_duplicate_pk", "duplicate_pk_groups", twice, twice == 0),
    ]
    row_checks = run_checks(per_key, checks)
    own = state.filter(
        (F.col("layer") == spec.layer)
        & (F.col("target_schema") == spec.target_schema)
        & (F.col("target_table") == spec.target_table)
    )
    # A table without history passes, and has its row.
    key = df.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in zip(STATE_KEY, (spec.layer, spec.target_schema, spec.target_table))])
    own = key.join(own, list(STATE_KEY), "left")
    return (
        row_checks.unionByName(check_freshness(own, as_of, spec.max_age_hours))
        .unionByName(check_schema(df, spec.expected_columns, f"{spec.name}_schema"))
    )


def assert_checks(results: DataFrame) -> None:
    """Raise when an ERROR check failed; WARN checks only report."""
    failed = results.filter((F.col("severity") == ERROR) & ~F.col("passed")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.check_name}: {r.metric}={r.value}" for r in failed))


def assert_contract(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """The same DataFrame, if its columns and types are exactly the declared ones."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    if list(have.items()) != list(contract.items()):
        wrong = [f"{n}: {have.get(n, 'absent')} is not {t}" for n, t in contract.items() if have.get(n) != t]
        extra = [f"{n}: not declared" for n in have if n not in contract]
        raise ValueError("contract broken: " + ("; ".join(wrong + extra) or "column order"))
    return df
