"""A corpus pipeline over ``documents``: each stage takes what the one before kept, and is written and read again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe import Bpe, bpe_encode
from strata.llm.common import col, fresh
from strata.llm.lines import OUT as LINE_COLUMNS
from strata.llm.lines import line_dedup
from strata.llm.minhash import OUT as NEAR_COLUMNS
from strata.llm.minhash import near_dedup
from strata.llm.mixing import OUT as MIX_COLUMNS
from strata.llm.mixing import mix, repeated
from strata.llm.toxicity import fit_toxicity, toxicity_scores
from strata.session import work_dir

# A text is rejected from this score on.
TOXIC = 0.3


def beside(docs: DataFrame, added: Sequence[str], apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``apply`` makes of the documents, with their own columns only; those named like ones it adds step aside for it."""
    names = {n.lower() for n in added}
    clash = [c for c in docs.columns if c.lower() in names]
    moved = dict(zip(clash, fresh(docs, *[f"{c}_of_documents" for c in clash])))
    out = apply(docs.withColumnsRenamed(moved))
    return out.select(*[col(moved.get(c, c)).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC``. Labels teach only where crc32(doc_id) mod 4 is not 2, as in op8.

    NULL and empty texts have no evidence and stay. Rows without an id are scored and teach nothing; rows that repeat are scored alike.
    """
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), training)
    return beside(docs, ("score",), lambda d: toxicity_scores(d, model).filter(F.col("score") < TOXIC))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are within one edit of an earlier one; ``n_chars`` follows the text.

    NULL texts come out empty.
    """
    out = beside(docs, LINE_COLUMNS, line_dedup)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    Texts without words all stay. Of rows that repeat an id all stay or none; of rows without an id that are alike, one.
    """
    return beside(docs, NEAR_COLUMNS, lambda d: near_dedup(d, shingle=5, percent=80).filter("kept"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as rows: a document as often as it is taken, up to twice. Texts without words are not taken.

    Rows that share an id share its draw; rows without one draw by their text.
    """
    return beside(docs, MIX_COLUMNS, lambda d: repeated(mix(d), d.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, little-endian unsigned 32-bit integers; NULL and empty texts have none. Every row stays, as it is."""
    bpe = Bpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe_encode(docs, bpe, carry=["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode),
]

# Learned scores, edit distances and merges are not expressible; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
