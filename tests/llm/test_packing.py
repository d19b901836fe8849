"""Packing against plain best fit, and token ids against the library of the vocabulary."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from strata.llm.packing import pack_pieces, packing_plan, token_pieces

WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain(lengths, capacity):
    """The same method one piece at a time: bins as lists."""
    large = sorted((x for x in lengths if 3 * x > capacity), reverse=True)
    bins = []
    while large:
        a = large.pop(0)
        mate = next((i for i, b in enumerate(large) if a + b <= capacity), None)
        bins.append([a] if mate is None else [a, large.pop(mate)])
    for x in sorted((x for x in lengths if 3 * x <= capacity), reverse=True):
        fitting = [b for b in bins if capacity - sum(b) >= x]
        if fitting:
            max(fitting, key=sum).append(x)
        else:
            bins.append([x])
    return Counter(tuple(sorted(b)) for b in bins)


def planned(lengths, capacity):
    """The sequences of a plan, checked for gapless places and whole numbers of pieces."""
    counts, bins, used = Counter(lengths), defaultdict(list), defaultdict(set)
    for n, first, many, per_bin, sequence, offset in packing_plan(counts, capacity):
        for k in range(many * per_bin):
            assert first + k not in used[n]
            used[n].add(first + k)
            bins[sequence + k // per_bin].append((offset + (k % per_bin) * n, n))
    assert {n: set(range(c)) for n, c in counts.items()} == used
    assert set(bins) == set(range(len(bins)))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))] and sum(n for _, n in b) <= capacity
    return Counter(tuple(sorted(n for _, n in b)) for b in bins.values())


def test_plan_is_plain_best_fit():
    rng = random.Random(13)
    for case in range(300):
        capacity = rng.choice([1, 2, 3, 7, 12, 30, 100])
        top = rng.choice([capacity, max(1, capacity // 2), max(1, capacity // 3)])
        lengths = [rng.randint(1, top) for _ in range(rng.randrange(60))]
        if case % 3 == 0 and lengths:
            lengths += [lengths[0]] * 40
        got, want = planned(lengths, capacity), plain(lengths, capacity)
        # Equal gaps may be told apart differently, but their number and sizes are the same.
        assert sum(got.values()) == sum(want.values())
        assert Counter(capacity - sum(b) for b in got.elements()) == Counter(capacity - sum(b) for b in want.elements())


def test_plan_does_not_grow_with_the_pieces():
    rng = random.Random(2)
    counts = {n: rng.randint(1, 50) for n in range(1, 2049)}
    few, many = packing_plan(counts, 2048), packing_plan({n: 10**9 * c for n, c in counts.items()}, 2048)
    assert len(many) < 4 * 2048 and len(few) < 4 * 2048
    total = sum(n * c for n, c in counts.items())
    assert max(s + b for _, _, b, _, s, _ in few) <= 1.02 * total / 2048 + 1


def test_bad_lengths():
    for counts in ({5: 1}, {0: 1}, {-1: 2}):
        with pytest.raises(ValueError):
            packing_plan(counts, 4)
    assert packing_plan({}, 4) == []


def check(rows, texts, known, capacity=2048):
    """Every document's pieces are its ids, every sequence is gapless and small enough."""
    ids = {k: [*known.encode(t or "", add_special_tokens=False).ids, 0] for k, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for k, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in pieces] == [(i, i * capacity) for i in range(-(-len(ids[k]) // capacity))]
        for r in pieces:
            part = ids[k][r.start : r.start + capacity]
            assert r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    assert len(by_sequence) == sum(plain([r.length for r in rows], capacity).values())


def test_query(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    check(entry.queries()["op13_packing"](spark, data).collect(), texts, Tokenizer.from_file(WORDS))


def test_awkward_texts(spark):
    rng = random.Random(4)
    letters = list("aB'sdll 0漢😀é́\xa0 \x1c\x85　\n\t\r\v\f.,ΣςİZ‍") + ["<|endoftext|>", "é", " ́"]
    texts = {i: "".join(rng.choice(letters) for _ in range(rng.randrange(80))) for i in range(400)}
    texts |= {400: None, 401: "", 402: " \n", 403: "word " * 9000, 404: "x" * 5000, 405: "ß" * 3 + " " * 3000, 406: "ab cd\n" * 60_000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    known = Tokenizer.from_file(WORDS)
    for r in token_pieces(docs, WORDS, 10**7).collect():
        want = [*known.encode(r.text or "", add_special_tokens=False).ids, 0]
        assert np.frombuffer(r.ids, "<u4").tolist() == want and (r.piece, r.start, r.length) == (0, 0, len(want))


def test_awkward_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (None, "c", "y"), (2, "word " * 50, "z"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string").selectExpr("*", "'k' AS row", "'k' AS ids", "'k' AS offset", "7 AS base")
    out = pack_pieces(token_pieces(docs, WORDS, 20), 20)
    assert out.columns == ["doc_id", "text", "size", "row", "base", "piece", "start", "length", "ids", "sequence_id", "offset"]
    got = out.collect()
    assert sorted(r.length for r in got) == [1, 1, 2, 3, 3, 11, 20, 20] and all(r.row == "k" and r.base == 7 for r in got)
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got) and {r.sequence_id for r in got} == set(range(4))
    assert pack_pieces(token_pieces(docs.filter("false"), WORDS), 20).collect() == []


def test_a_frequent_length_is_spread(spark):
    pieces = spark.range(30_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, id % 50, 7) + 1 AS length")
    got = pack_pieces(pieces, 64).groupBy("sequence_id").agg({"length": "sum", "offset": "min"}).collect()
    total = pieces.groupBy().sum("length").collect()[0][0]
    assert max(r["sum(length)"] for r in got) <= 64 and all(r["min(offset)"] == 0 for r in got) and len(got) <= 1.001 * total / 64 + 1
