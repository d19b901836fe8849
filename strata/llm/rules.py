"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import BLANKS, col, content, fresh, without, words

OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rules", "kept")

# Frequent words of English, German, French and Spanish. Fixed values.
STOP_WORDS = (
    "a", "and", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with",
    "das", "der", "die", "den", "ein", "eine", "für", "ist", "mit", "sich", "und", "von", "zu", "auf",
    "au", "avec", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "pas", "pour", "que", "qui", "un", "une",
    "al", "con", "del", "el", "es", "las", "lo", "los", "para", "por", "se", "su", "una", "y",
)


@dataclass(frozen=True)
class Rule:
    """A text passes if ``low <= metric <= high``; a missing bound always holds."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("length", "n_words", low=50),
    Rule("mean_word", "chars_per_word", low=2.0, high=15.0),
    Rule("symbols", "symbols_per_word", high=0.2),
    Rule("stop_words", "stop_words_per_word", low=0.02),
    Rule("duplicate_lines", "dup_lines_per_line", high=0.5),
    Rule("repetition", "repeat_words_per_word", high=0.5),
)


def _per(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _by_hash(hashes: Column) -> Column:
    """Windows as (hash, position) in hash order, for texts with a window that occurs twice; NULL for others."""
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(pairs))


def _twice(by_hash: Column) -> Column:
    """Positions, ascending, of windows that have the hash of a neighbour in hash order."""
    same = F.filter(by_hash, lambda x, i: (x["h"] == F.get(by_hash, i - 1)["h"]) | (x["h"] == F.get(by_hash, i + 1)["h"]))
    return F.sort_array(F.transform(same, lambda x: x["i"]))


def quality_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, stop_words: Sequence[str] = STOP_WORDS, text: str = "text"
) -> DataFrame:
    """All rows with the counts, ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``.

    ``base_failed``: under 50 words, or over half of the words repeated. A metric is one of ``n_words``,
    ``chars_per_word``, ``symbols_per_word``, ``stop_words_per_word``, ``dup_lines_per_line`` and
    ``repeat_words_per_word``. No row moves. NULL and empty texts have no words and fail. Columns of the input
    named like an added one are replaced.
    """
    docs = without(docs, OUT)
    body, ws, lines, hashes, by_hash, at = fresh(docs, "body", "ws", "lines", "hashes", "by_hash", "at")
    staged = docs.withColumn(body, content(text)).withColumn(ws, words(F.col(body)))
    staged = staged.withColumn(
        lines, F.filter(F.split(F.col(body), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    ).withColumn(
        hashes,
        F.when(
            F.size(ws) > 2,
            F.transform(
                F.sequence(F.lit(0), F.size(ws) - 3),
                lambda i: F.xxhash64(F.get(F.col(ws), i), F.get(F.col(ws), i + 1), F.get(F.col(ws), i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # Each step is a column of its own: a lambda must find its arrays made, not make them per element.
    staged = staged.withColumn(by_hash, _by_hash(F.col(hashes))).withColumn(at, _twice(F.col(by_hash)))
    # A repeated window adds its words up to the next one, three at most.
    gaps = F.transform(F.col(at), lambda p, i: F.least(F.lit(3), F.get(F.col(at), i + 1) - p))
    common = [w.lower() for w in stop_words]
    n_stop, n_lines = fresh(docs, "n_stop", "n_lines")
    counted = staged.select(
        *[col(c) for c in docs.columns],
        F.size(ws).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(F.col(ws), "")).cast("bigint").alias("word_chars"),
        (F.octet_length(F.col(body)) - F.octet_length(F.regexp_replace(F.col(body), r"[#*$%&|<>]", ""))).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(F.col(lines)))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size(F.filter(F.col(ws), lambda w: F.lower(w).isin(common))).alias(n_stop),
        F.size(lines).alias(n_lines),
    )
    metrics = {
        "n_words": F.col("n_words"),
        "chars_per_word": _per(F.col("word_chars"), F.col("n_words")),
        "symbols_per_word": _per(F.col("n_symbols"), F.col("n_words")),
        "stop_words_per_word": _per(F.col(n_stop), F.col("n_words")),
        "dup_lines_per_line": _per(F.col("n_dup_lines"), F.col(n_lines)),
        "repeat_words_per_word": _per(F.col("n_repeat_words"), F.col("n_words")),
    }
    broken = []
    for rule in rules:
        value, fails = metrics[rule.metric], F.lit(False)
        if rule.low is not None:
            fails = fails | (value < rule.low)
        if rule.high is not None:
            fails = fails | (value > rule.high)
        broken.append(F.when(fails, F.lit(rule.name)))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        counted.withColumn("base_failed", base)
        .withColumn("failed_rules", F.array_compact(F.array(*broken)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .drop(n_stop, n_lines)
    )
