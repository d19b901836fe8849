"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import col, content, fresh, without, words
from strata.session import kept

OUT = ("size", "source_size", "target", "taken")
# Rows of one bin of keys, on average; a bin is sorted by one task.
BIN_ROWS = 2_000
# Weights are told apart by powers of two below the largest, as far as cutting the bins goes.
LEVELS = 16


def text_weight(text: str) -> Column:
    """Quality weight of a text: 1 for plain prose, down to 1/20 as symbols take over."""
    body = content(text)
    symbols = F.octet_length(body) - F.octet_length(F.regexp_replace(body, r"[#*$%&|<>!]", ""))
    return F.greatest(F.lit(0.05), 1.0 - 4.0 * symbols / F.greatest(F.octet_length(body), F.lit(1)))


def shares(sizes: DataFrame, source: str, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Source, size and target words of each source.

    Sources in code point order, NULL last, get the weights in turn. ``share`` times all words are
    dealt by weight; what a source would get beyond ``cap`` times its size is dealt again among the
    rest until no source is above. That ends where all others get the same words per unit of weight:
    with sources sorted by cap per weight, the first whose cap is not reached fixes that level.
    The table has one row per source of the mix, so its windows are small.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1, F.lit(len(weights)))
    listed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    listed = listed.withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col(source).asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(everything) * share
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    listed = listed.withColumn("level", level)
    # Up to the fixing source the level lies above the cap; from it on every row would be capped no more.
    fixed = F.min(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)
    return listed.withColumn("fixed", fixed["level"]).select(
        source, "source_size", F.when(F.col("fixed").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("fixed"))).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
    quality: Column | None = None,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """All rows with ``size`` (words), ``source_size``, ``target`` and ``taken`` (words the mix takes).

    Every whole multiple of a source's size in its target is an epoch that takes every document once.
    The rest is filled by weighted sampling without replacement: each document draws an exponential
    key with its quality weight as rate, and whole documents are taken in key order as long as more
    than half of a document still fits under the budget. Keys come from a digest of seed and id, so
    reruns agree.

    Running sums are taken in two steps: words per bin of keys, and within each bin. Bins cut the
    keys of a source evenly whatever the source's size, so no task gets a whole source.

    NULL text has no words and is never taken, NULL source is a source of its own. Rows that repeat an id have the
    same draw and are ordered by text; without an id the draw comes from a digest of the text. Weights must be positive. Columns of the input named like an added one are replaced.
    """
    docs = without(docs, OUT)
    key, rate, mark, bin, before, plan, plan_source, sum_source, sum_bin, offset = fresh(
        docs, "key", "rate", "mark", "bin", "before", "plan", "plan_source", "sum_source", "sum_bin", "offset"
    )
    body = content(text)
    named = F.coalesce(col(id).cast("string"), F.concat(F.lit("text "), F.xxhash64(body).cast("string")))
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), named)), 1, 12), 16, 10).cast("double")
    rows = (
        docs.withColumn("size", F.size(words(body)).cast("bigint"))
        .withColumn(rate, F.greatest(quality if quality is not None else text_weight(text), F.lit(1e-6)).cast("double"))
        .withColumn(key, -F.log((draw + 0.5) / float(2**48)) / F.col(rate))
        .withColumn(mark, F.xxhash64(body))
    )
    per_source = kept(_plans(rows.select(col(source).alias("src"), "size", F.col(rate).alias("rate")), weights, share, cap, bin_rows))
    small = per_source.select(F.col("src").alias(plan_source), F.struct("*").alias(plan))
    rows = rows.join(small, col(source).eqNullSafe(F.col(plan_source))).withColumn(bin, _bin(F.col(key), F.col(plan)))
    sums = rows.groupBy(col(source).alias(sum_source), F.col(bin).alias(sum_bin)).agg(F.sum("size").alias("words"))
    running = Window.partitionBy(sum_source).orderBy(sum_bin).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn(offset, F.coalesce(F.sum("words").over(running), F.lit(0))).drop("words")
    within = Window.partitionBy(col(source), bin).orderBy(key, col(id), mark).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn(before, F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(starts, col(source).eqNullSafe(F.col(sum_source)) & (F.col(bin) == F.col(sum_bin)))
    start = F.col(before) + F.col(offset)
    extra = F.when(start + F.col("size") / 2.0 <= F.col(plan)["rest"], F.col("size")).otherwise(0)
    return placed.select(
        *[col(c) for c in docs.columns],
        "size",
        F.col(plan)["source_size"].alias("source_size"),
        F.col(plan)["target"].alias("target"),
        (F.col(plan)["epochs"] * F.col("size") + extra).cast("bigint").alias("taken"),
    )


def _plans(narrow: DataFrame, weights: Sequence[float], share: float, cap: float, bin_rows: int) -> DataFrame:
    """Per source: size, target, epochs, words left for sampling, number of bins, and how its weights are spread."""
    tops = narrow.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"), F.max("rate").alias("top"))
    tops = kept(tops)
    level = F.least(F.floor(F.log2(F.col("top") / F.col("rate"))), F.lit(LEVELS - 1))
    spread = (
        narrow.join(tops.select(F.col("src").alias("s"), "top"), F.col("src").eqNullSafe(F.col("s")))
        .groupBy("src")
        .agg(F.array(*[F.avg((level == j).cast("double")) for j in range(LEVELS)]).alias("spread"))
        .withColumnRenamed("src", "s")
    )
    targets = shares(tops.select("src", "source_size"), "src", weights, share, cap).withColumnRenamed("src", "t")
    return (
        tops.join(spread, F.col("src").eqNullSafe(F.col("s")))
        .join(targets.drop("source_size"), F.col("src").eqNullSafe(F.col("t")))
        .drop("s", "t")
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("bins", F.ceil(F.col("n") / bin_rows))
    )


def _bin(key: Column, plan: Column) -> Column:
    """The key's place in its source's distribution, a mixture of exponentials, as one of the source's bins."""
    passed = F.lit(0.0)
    for j in range(LEVELS):
        passed = passed + plan["spread"][j] * (1.0 - F.exp(-key * plan["top"] * float(2.0**-j) * 0.75))
    return F.least(F.floor(passed * plan["bins"]), plan["bins"] - 1)


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix as rows: every document as often as it was taken."""
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    return mixed.filter(copies > 0).select(*[col(c) for c in columns], F.explode(F.array_repeat(F.lit(1), copies)).alias("_copy")).drop("_copy")
