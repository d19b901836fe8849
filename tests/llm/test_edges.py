"""Every operator on awkward rows: NULLs, empty and very long texts, ties, repeated rows, clashing names, empty tables."""

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strata.llm.bpe import Bpe, bpe_decode, bpe_encode
from strata.llm.compression import fit_quality, quality_scores
from strata.llm.exact import exact_dedup
from strata.llm.lines import line_dedup
from strata.llm.minhash import near_dedup
from strata.llm.mixing import mix, repeated
from strata.llm.pii import mask, pii_spans
from strata.llm.rules import quality_rules
from strata.llm.sharding import kd_shards
from strata.llm.toxicity import fit_toxicity, toxicity_scores

SCHEMA = "doc_id long, text string, source string, lang string, label int"
LONG = "word " * 30_000 + "x" * 50_000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog of the house.\nA second line that is long enough.", "a", "en", 1),
    (1, "The quick brown fox jumps over the lazy dog of the house.\nA second line that is long enough.", "a", "en", 1),
    (2, "The quick brown fox jumps over the lazy dog of the house.\nA second line that is long enough!", "a", None, 0),
    (3, None, None, None, None),
    (3, "", "b", "de", 1),
    (4, " \t\n \x0b", "b", "de", 0),
    (None, "call +49 (30) 1234567 about card 4111 1111 1111 1111", None, "fr", 1),
    (None, None, "c", "fr", None),
    (5, LONG, "c", "es", 0),
    (6, LONG, "c", "es", 1),
    (7, "ünïcödé — 漢字 😀 \n\n\n", "", "", 1),
]
# Names that the operators use inside or add.
CLASH = [
    "kept", "keep_id", "group_size", "key", "body", "piece", "size", "keep", "shard", "slot", "d0", "tie", "node", "n_words", "ws", "lines",
    "spans", "score", "k", "th", "drop", "left", "n_lines", "n_shingles", "component_id", "target", "taken", "source_size", "plan", "bin",
    "rate", "mark", "before", "n_tokens", "ids", "packed", "decoded", "n", "count", "bins", "first", "pos", "d", "comp", "s1", "words",
]


def bpe(spark):
    return Bpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def quality(docs):
    return quality_scores(docs, fit_quality(docs, docs.select("doc_id", F.col("label").alias("quality")), F.lit(True)))


def toxicity(docs):
    return toxicity_scores(docs, fit_toxicity(docs, docs.select("doc_id", F.col("label").alias("toxic")), F.lit(True)))


OPERATORS = {
    "near": near_dedup,
    "shards": lambda docs: kd_shards(docs, ["lang", "source", "label", "doc_id"], leaves=3),
    "exact": exact_dedup,
    "quality": quality,
    "rules": quality_rules,
    "pii": lambda docs: mask(pii_spans(docs)),
    "lines": line_dedup,
    "toxicity": toxicity,
    "mix": mix,
    "bpe": lambda docs: bpe_decode(bpe_encode(docs, bpe(docs.sparkSession)), bpe(docs.sparkSession)),
}


@pytest.fixture(scope="module")
def awkward(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(awkward, name):
    out = OPERATORS[name](awkward)
    assert len(set(map(str.lower, out.columns))) == len(out.columns)
    assert set(awkward.columns) <= set(out.columns)
    rows = out.collect()
    assert len(rows) == len(ROWS)
    untouched = [c for c in CLASH if out.schema[c].dataType == awkward.schema[c].dataType]
    assert len(untouched) > 30 and all(r[c] == "x" for r in rows for c in untouched if c not in ("ids",))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    docs = spark.createDataFrame([], SCHEMA)
    assert OPERATORS[name](docs).collect() == []


def test_repeated_rows_share_a_verdict(awkward):
    for f in (exact_dedup, near_dedup):
        same = [r for r in f(awkward).collect() if r.doc_id == 1]
        assert len(same) == 2 and same[0] == same[1]


def test_mix_as_rows(awkward):
    mixed = mix(awkward)
    wanted = sum(r.taken // r["size"] for r in mixed.collect() if r["size"])
    rows = repeated(mixed, awkward.drop("size", "source_size", "target", "taken").columns).count()
    assert rows == wanted


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels beside documents: ids above 100 with and without a toxic word."""
    path = str(tmp_path_factory.mktemp("labelled"))
    spark.createDataFrame([(i, i % 2) for i in range(100, 160)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def corpus(spark):
    labelled = [(i, f"plain words number {i} here" + " vileslur" * (i % 2), "a", "en", 1) for i in range(100, 160)]
    docs = spark.createDataFrame(ROWS + labelled, SCHEMA).repartition(3).withColumn("n_chars", F.char_length("text").cast("long"))
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_on_awkward_rows(spark, folder, name):
    docs = corpus(spark)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    rows = out.collect()
    assert all(r[c] == "x" for r in rows for c in CLASH)
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in rows)
    every = sorted((r[0] is None, r[0] or 0) for r in ROWS) + [(False, i) for i in range(100, 160)]
    if name == "toxicity":
        gone = {(False, i) for i in range(101, 160, 2)}
        assert ids == sorted(x for x in every if x not in gone)
    elif name == "line_dedup":
        assert ids == sorted(every) and all(r.n_chars == len(r.text) for r in rows)
        # Rows that repeat are one document, whose first line is the first of its kind.
        assert sum("quick brown" in r.text for r in rows) == 2
    elif name == "near_dedup":
        # Of the two long texts the first stays, and both rows of id 1, which are one document.
        assert (False, 6) not in ids and ids.count((False, 1)) == 2 and ids.count((True, 0)) == 2 and ids.count((False, 3)) == 2
    else:
        assert set(ids) <= set(every) and not {(False, 3), (False, 4)} & set(ids)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, folder, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, corpus(spark).filter("false"), folder).collect() == []


def test_encoding_stage_on_awkward_rows(spark, folder):
    rows = corpus_pipeline.encode(spark, corpus(spark), folder).collect()
    assert len(rows) == len(ROWS) + 60 and sum(r.n_tokens == 0 and bytes(r.ids) == b"" for r in rows) == 3
