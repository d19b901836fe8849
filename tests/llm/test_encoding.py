"""Encoding against the reference library of the vocabulary, and the pipeline against plain Python."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm.bpe import Bpe, Coder, bpe_decode, bpe_encode, parse_ranks, unpack
from tests.llm.test_dedup import linked

with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
    RANKS = parse_ranks(f.read())


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_coder(known):
    rng = random.Random(6)
    coder = Coder(RANKS, public_tokenizers.PATTERN)
    letters = [chr(x) for x in range(1, 0x180)] + list("\x85\xa0   　漢😀​﻿\x1c\x1f")
    texts = ["".join(rng.choice(letters if k % 3 else "aaab  the\n'sdll") for _ in range(rng.randrange(60))) for k in range(3000)]
    texts += ["a" * 5000, "ab" * 4000, " " * 3000, "thequickbrown" * 500, "=-" * 3000, "<|endoftext|>"]
    for t in texts:
        packed = coder.encode(t)
        assert np.frombuffer(packed, "<u4").tolist() == known.encode_ordinary(t)
        assert coder.decode(packed) == t.encode()
    assert not coder.buckets and not any(coder.lower)


def test_query(spark, data, known):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = entry.queries()["op10_bpe"](spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = known.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_round_trip_and_arrays(spark, known):
    bpe = Bpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = spark.createDataFrame([(1, "hello world"), (2, None), (3, "x" * 3000)], "doc_id long, text string")
    rows = bpe_decode(bpe_encode(docs, bpe), bpe).withColumn("list", unpack("ids")).collect()
    for r in rows:
        assert r.list == known.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()


def test_pipeline(spark, data):
    """Each stage against its own input; the whole against its stages."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "mix", "encode"] and corpus_pipeline.ORACLE_SQL is None
    scores = {r.doc_id: r.score for r in entry.queries()["op8_toxicity"](spark, data).collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in kept.collect()}
        kept = stage(spark, kept, data)
        assert kept.columns == docs.columns
        rows = kept.collect()
        after = {r.doc_id: r for r in rows}
        kept = spark.createDataFrame(rows, docs.schema)
        if name == "toxicity":
            assert set(after) == {i for i in before if scores[i] < 0.3}
        elif name == "line_dedup":
            assert set(after) == set(before)
            for i, r in after.items():
                assert set(r.text.split("\n")) <= set(before[i].text.split("\n")) | {""} and r.n_chars == len(r.text)
        elif name == "near_dedup":
            want = linked({i: r.text for i, r in before.items()}, 5)
            assert set(after) == {i for i, (_, c) in want.items() if c == i}
        else:
            assert all(before[r.doc_id] == r for r in rows) and max(sum(x.doc_id == i for x in rows) for i in after) <= 2
    last = sorted((r.doc_id, r.n_tokens, bytes(r.ids)) for r in corpus_pipeline.STAGES[-1][1](spark, kept, data).collect())
    whole = sorted((r.doc_id, r.n_tokens, bytes(r.ids)) for r in corpus_pipeline.run(spark, data).collect())
    assert last == whole
