"""Line deduplication by a deletion-neighbourhood join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import BLANKS, NO_ID, col, content, fresh, without
from strata.session import Workspace, kept

OUT = ("n_lines", "n_dropped")
# Lines with fewer characters are left alone unless asked for: at one edit, short lines are alike by chance.
LEAST_CHARS = 16
# Up to so many characters a half tells too little; such lines, and those one longer, emit their deletions without sharing one.
NO_HALVES = 8
# Variants are hashed by chunks of so many characters, so that the work for a line grows with its length only.
CHUNK = 64


def _halves(line: Column, length: Column) -> Column:
    """Keys of which two lines within one edit share at least one.

    An edit leaves the first or the last ``a`` characters alone if both together are no more than the line. ``a`` is a
    multiple of four near half the length; where one more character would make it another, both are keys.
    """

    def pair(a: Column) -> list[Column]:
        return [
            F.xxhash64(F.lit("first"), a, F.substring(line, F.lit(1), a)),
            F.xxhash64(F.lit("last"), a, F.substring(line, length - a + 1, a)),
        ]

    a = (F.floor(length / 8) * 4).cast("int")
    both = F.array(*pair(a))
    halves = F.when(length % 8 == 0, F.concat(both, F.array(*pair(a - 4)))).otherwise(both)
    return F.when(length > NO_HALVES, halves).otherwise(F.slice(both, 1, 0))


def _variants(lines: DataFrame) -> DataFrame:
    """(line, key, cut): the line and all its one-character deletions, hashed, with the place of the deletion (-1: none).

    Chunk ``j`` takes the deletions in characters ``64 j`` to ``64 j + 63``. What is left of it and what is right of it is
    hashed once; lines whose surroundings of a chunk no other line shares have no partner there and emit nothing.
    A line that ends with a chunk has an empty one behind it, which gives its whole key to lines with one more character there.
    """
    chunks = lines.select("d", "line", F.explode(F.sequence(F.lit(0), F.floor(F.char_length("line") / CHUNK).cast("int"))).alias("j"))
    at = F.col("j") * CHUNK
    chunks = chunks.select(
        "d",
        "j",
        F.xxhash64("j", F.substring("line", F.lit(1), at)).alias("before"),
        F.xxhash64(F.substring("line", at + CHUNK + 1, F.char_length("line"))).alias("after_whole"),
        F.xxhash64(F.substring("line", at + CHUNK + 2, F.char_length("line"))).alias("after_cut"),
        F.substring("line", at + 1, F.lit(CHUNK + 1)).alias("piece"),
    )
    around = chunks.select("d", "j", F.explode(F.array(F.xxhash64("before", "after_whole"), F.xxhash64("before", "after_cut"))).alias("around")).distinct()
    shared = around.groupBy("around").count().filter("count > 1").select("around")
    live = around.join(shared, "around", "left_semi").select("d", "j").distinct()
    chunks = chunks.join(live, ["d", "j"], "left_semi")
    whole = F.struct(F.lit(-1).alias("cut"), F.xxhash64("before", F.left("piece", F.lit(CHUNK)), "after_whole").alias("key"))
    deleted = F.transform(
        F.when(F.col("piece") == "", F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.least(F.char_length("piece"), F.lit(CHUNK)) - 1)),
        lambda i: F.struct(
            (i + F.col("j") * CHUNK).alias("cut"),
            F.xxhash64(
                F.col("before"),
                F.concat(F.substring(F.col("piece"), F.lit(1), i), F.substring(F.col("piece"), i + 2, F.lit(CHUNK + 1))),
                F.col("after_cut"),
            ).alias("key"),
        ),
    )
    return chunks.select("d", F.inline(F.concat(F.array(whole), deleted)))


def _near(work: Workspace, docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Digests of lines that have an earlier one within one edit, equal lines aside.

    ``lines`` has one row per different line with its first occurrence.
    """
    keys = lines.select("d", F.explode("halves").alias("half"))
    shared = keys.groupBy("half").count().filter("count > 1").select("half")
    some = keys.join(shared, "half", "left_semi").select("d").union(lines.filter("tiny").select("d")).distinct()
    places = lines.join(some, "d", "left_semi").select("first.*", "first", "d").groupBy("k", "th").agg(F.collect_list(F.struct("pos", "first", "d")).alias("places"))
    texts = docs.join(places, ["k", "th"]).dropDuplicates(["k", "th"])
    texts = texts.select(F.split("text", "\n").alias("all"), F.inline("places"))
    texts = work.stage(texts.select("d", "first", F.get("all", F.col("pos")).alias("line")))
    spots = _variants(texts.select("d", "line")).join(texts.select("d", "first"), "d")
    # Of lines that lose the same character's place, all are one substitution apart: each is compared with the earliest.
    # A line that equals another's variant is one insertion away from it. A variant has few lines: one per character and place.
    same = Window.partitionBy("key")
    spots = spots.withColumn("earliest", F.min(F.struct("first", "d")).over(Window.partitionBy("key", "cut"))["d"]).withColumn(
        "whole", F.max(F.when(F.col("cut") < 0, F.col("d"))).over(same)
    )
    pairs = spots.select("d", F.explode(F.array("earliest", "whole")).alias("other")).filter("d != other").distinct()
    right = texts.select(F.col("d").alias("other"), F.col("first").alias("other_first"), F.col("line").alias("other_line"))
    pairs = pairs.join(texts, "d").join(right, "other").filter(F.levenshtein("line", "other_line", 1) >= 0)
    return pairs.select(F.when(F.col("first") > F.col("other_first"), F.col("d")).otherwise(F.col("other")).alias("d")).distinct()


def line_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, short_lines: bool = False
) -> DataFrame:
    """All rows, the text without lines that have an earlier line within one edit, with ``n_lines`` and ``n_dropped``.

    Lines are split at ``\\n``. A line goes if an earlier one of the corpus (by id, then position) equals
    it or is one inserted, deleted or replaced character away, whether that one stays or not. Lines of fewer than ``least_chars``
    characters (16 at least) stay, unless ``short_lines`` puts lines of any length under the same rule; those without a word
    always stay. No text is compared by digest alone but for equal lines (128 bits).

    NULL counts as empty and becomes an empty text. Rows that repeat an id and a text are one document; texts under one id
    are ordered by a digest. A NULL id comes before all others. A document that loses all lines stays, with an empty text.
    Columns of the input named like an added one are replaced.
    """
    if least_chars < 16:
        raise ValueError("least_chars is 16 or more; short_lines=True takes all lines")
    docs = without(docs, OUT)
    with Workspace(docs.sparkSession, "lines") as work:
        ident, digest = F.coalesce(col(id).cast("bigint"), F.lit(NO_ID)), F.xxhash64(content(text))
        base = docs.select(ident.alias("k"), digest.alias("th"), content(text).alias("text"))
        rows = base.select("k", "th", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter(
            (F.char_length("line") >= (0 if short_lines else least_chars)) & (F.btrim("line", F.lit(BLANKS)) != "")
        )
        length = F.char_length("line")
        rows = rows.select(
            "k", "th", "pos", F.unhex(F.md5(F.col("line").cast("binary"))).alias("d"), _halves(F.col("line"), length).alias("halves"), (length <= NO_HALVES + 1).alias("tiny")
        )
        lines = work.stage(
            rows.groupBy("d").agg(
                F.min(F.struct("k", "th", "pos")).alias("first"), F.count("*").alias("n"), F.first("halves").alias("halves"), F.first("tiny").alias("tiny")
            )
        )
        near = work.stage(_near(work, base, lines).select("d", F.lit(True).alias("near")))
        gone = work.stage(
            lines.join(near, "d", "left").filter("n > 1 or near").select("d", "first", F.coalesce("near", F.lit(False)).alias("near"))
        )
        drops = rows.select("k", "th", "pos", "d").join(gone, "d").filter(F.col("near") | (F.struct("k", "th", "pos") != F.col("first")))
        k, th, drop = fresh(docs, "k", "th", "drop")
        drops = kept(drops.groupBy(F.col("k").alias(k), F.col("th").alias(th)).agg(F.sort_array(F.collect_set("pos")).alias(drop)))
    body, parts, left = fresh(docs, "body", "parts", "left")
    out = docs.withColumn(k, ident).withColumn(th, digest).join(drops, [k, th], "left")
    out = out.withColumn(parts, F.split(content(text), "\n")).withColumn(
        left,
        F.when(F.col(drop).isNull(), F.col(parts)).otherwise(F.filter(F.col(parts), lambda _, i: ~F.array_contains(F.col(drop), i))),
    )
    return out.select(
        *[F.array_join(F.col(left), "\n").alias(c) if c == text else col(c) for c in docs.columns],
        F.size(parts).cast("bigint").alias("n_lines"),
        (F.size(parts) - F.size(left)).cast("bigint").alias("n_dropped"),
    )
