"""Comparing two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import sortable
from strata.specs import key_list


# Buckets of rows that are compared as a whole first, by sums of their rows' hashes.
BUCKETS = 1 << 16


def differing_buckets(
    signed: DataFrame, columns: Sequence[str], sign: str, buckets: int = BUCKETS, by: Sequence[str] | None = None
) -> DataFrame:
    """Buckets (``_bucket``) of rows, by a hash of the columns ``by`` (all unless given), whose signed rows do not cancel out.

    Of each bucket only the sums of two independent 64-bit hashes of its rows move, each in two halves so that no sum overflows. Equal
    rows have equal hashes, so buckets of the same rows have the same sums whatever their order; rows that are not the same have them
    with a probability of about 2^-128.
    """
    hashed = signed.select(
        F.col(sign).cast("bigint").alias("_s"),
        bucket_of(signed, by or columns, buckets).alias("_bucket"),
        row_hash(signed, columns, "one").alias("_h0"),
        row_hash(signed, columns, "two").alias("_h1"),
    )
    sums = [F.sum("_s").alias("_n")]
    for h in ("_h0", "_h1"):
        sums += [F.sum(F.col("_s") * F.shiftright(h, 32)).alias(f"{h}_high"), F.sum(F.col("_s") * F.col(h).bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{h}_low")]
    totals = hashed.groupBy("_bucket").agg(*sums)
    unlike = F.lit(False)
    for c in totals.columns[1:]:
        unlike = unlike | (F.col(c) != 0)
    return totals.filter(unlike).select("_bucket")


def row_hash(df: DataFrame, columns: Sequence[str], salt: str) -> Column:
    """A hash of a row's values. A NULL counts where it stands, and values of a type without a hash are taken as text."""
    parts = [F.lit(salt)]
    for c in columns:
        value = F.col(f"`{c}`")
        if isinstance(df.schema[c].dataType, (T.MapType, T.VariantType)):
            value = F.to_json(value)
        parts += [value, value.isNull()]
    return F.xxhash64(*parts)


def bucket_of(df: DataFrame, columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(row_hash(df, columns, "one"), F.lit(buckets))


def audit_except(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows of one version that the other lacks, counted as a multiset: (columns, side, n_rows).

    Both versions are stacked with opposite signs. First the sums of the rows' hashes are compared bucket by bucket, see
    :func:`differing_buckets`; then only rows of buckets that differ move, grouped by all columns. Equal versions are so
    told at the cost of one narrow row per bucket, and a few differing rows at little more. The list of differing buckets is
    broadcast; it has at most ``buckets`` numbers. Copies of a row meet already in the map-side aggregation.
    """
    columns = a.columns
    if set(columns) != set(b.columns):
        raise ValueError(f"only one version has the columns {sorted(set(columns) ^ set(b.columns))}")
    signed = a.withColumn("_sign", F.lit(1)).unionByName(b.select(*columns).withColumn("_sign", F.lit(-1)))
    unlike = differing_buckets(signed, columns, "_sign", buckets)
    rows = signed.withColumn("_bucket", bucket_of(signed, columns, buckets)).join(F.broadcast(unlike), "_bucket", "left_semi")
    net = rows.groupBy(*columns).agg(F.sum("_sign").alias("_net")).filter(F.col("_net") != 0)
    side = F.when(F.col("_net") > 0, "a_only").otherwise("b_only")
    return net.select(*columns, side.alias("side"), F.abs("_net").cast("bigint").alias("n_rows"))


def audit_compare(a: DataFrame, b: DataFrame, keys: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Row and value agreement of two versions: (column_name, outcome, n_rows).

    Keys are compared under ``column_name = '*'``: matched, a_only, b_only, and keys that are not
    unique on a side (their values are not compared). A column only one version has is reported as
    ``only_in_a`` or ``only_in_b``, with that version's rows. One grouping by key replaces a full outer
    join, so repeated keys shrink before the shuffle instead of multiplying after it.

    Rows are dealt into ``buckets`` by their key, and the sums of the rows' hashes are compared first (see
    :func:`differing_buckets`). Where they agree both versions have the same rows: of those, one version's keys move, with a flag per
    column for NULL. Only in buckets that differ whole rows of both versions do.
    """
    names = key_list(keys)
    columns = [c for c in a.columns if c in b.columns and c not in names]
    signed = a.select(*names, *columns, F.lit(1).alias("_sign")).unionByName(b.select(*names, *columns, F.lit(-1).alias("_sign")))
    unlike = F.broadcast(differing_buckets(signed, [*names, *columns], "_sign", buckets, names))
    rows = signed.withColumn("_bucket", bucket_of(signed, names, buckets))

    in_a = F.col("_sign") > 0
    pairs = []
    for i, c in enumerate(columns):
        value = sortable(a.schema[c])
        pairs += [F.max(F.when(in_a, value)).alias(f"a{i}"), F.max(F.when(~in_a, value)).alias(f"b{i}")]
    apart = rows.join(unlike, "_bucket", "left_semi").groupBy(*names).agg(F.count_if(in_a).alias("_na"), F.count_if(~in_a).alias("_nb"), *pairs)
    na, nb = F.col("_na"), F.col("_nb")
    matched = (na == 1) & (nb == 1)
    told = {
        ("*", "matched"): matched,
        ("*", "a_only"): (na == 1) & (nb == 0),
        ("*", "b_only"): (na == 0) & (nb == 1),
        ("*", "key_not_unique"): (na > 1) | (nb > 1),
    }
    told |= {(c, "only_in_a"): na > 0 for c in a.columns if c not in b.columns}
    told |= {(c, "only_in_b"): nb > 0 for c in b.columns if c not in a.columns}
    for i, c in enumerate(columns):
        x, y = F.col(f"a{i}"), F.col(f"b{i}")
        told |= {
            (c, "equal"): matched & (x == y),
            (c, "both_null"): matched & x.isNull() & y.isNull(),
            (c, "null_in_a"): matched & x.isNull() & y.isNotNull(),
            (c, "null_in_b"): matched & x.isNotNull() & y.isNull(),
            (c, "different"): matched & (x != y),
        }

    empty = [F.col(f"`{c}`").isNull().alias(f"n{i}") for i, c in enumerate(columns)]
    mine = rows.filter(in_a).select("_bucket", *names, *empty).join(unlike, "_bucket", "left_anti")
    alike = mine.groupBy(*names).agg(F.count("*").alias("_n"), *[F.bool_or(f"n{i}").alias(f"n{i}") for i in range(len(columns))])
    one = F.col("_n") == 1
    same = {("*", "matched"): one, ("*", "key_not_unique"): ~one}
    same |= {(c, o): F.lit(True) for c, o in told if o in ("only_in_a", "only_in_b")}
    for i, c in enumerate(columns):
        same |= {(c, "equal"): one & ~F.col(f"n{i}"), (c, "both_null"): one & F.col(f"n{i}")}

    def counted(grouped: DataFrame, outcomes: dict[tuple[str, str], Column]) -> DataFrame:
        cells = [
            F.struct(F.lit(c).alias("column_name"), F.lit(o).alias("outcome"), F.count_if(cond).alias("n_rows"))
            for (c, o), cond in outcomes.items()
        ]
        return grouped.agg(F.array(*cells).alias("r")).select(F.inline("r"))

    both = counted(apart, told).unionByName(counted(alike, same))
    return both.groupBy("column_name", "outcome").agg(F.sum("n_rows").alias("n_rows"))
