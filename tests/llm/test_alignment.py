"""Alignment against a plain version that counts bytes token by token over whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry
from strata.llm.alignment import Pair, Vocabularies, align_tokens, count_links, named_pairs, pair_counts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in kept]
        self.letters = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}

    def align(self, text):
        """(groups of (ids of A, ids of B), links), or None."""
        if not text:
            return None
        whole = (" " + text).encode()
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            return None
        ends = []
        for side in (a, b):
            at, out = 0, {}
            for i, t in side:
                at += len(t)
                out[at] = i
            ends.append(out)
        groups, x, y = [], [], []
        ia, ib = iter(sorted(ends[0])), iter(sorted(ends[1]))
        ea, eb = next(ia), next(ib)
        while True:
            if ea <= eb:
                x.append(ends[0][ea])
            if eb <= ea:
                y.append(ends[1][eb])
            if ea == eb:
                groups.append((x, y))
                x, y = [], []
                ea, eb = next(ia, None), next(ib, None)
                if ea is None:
                    break
            elif ea < eb:
                ea = next(ia)
            else:
                eb = next(ib)
        return groups, [(ends[0][e], ends[1][e]) for e in sorted(set(ends[0]) & set(ends[1]))]

    def rows(self, texts):
        """doc_id -> the contract's columns."""
        done = {k: self.align(t) for k, t in texts}
        counts = Counter(p for d in done.values() if d for p in d[1])
        best = {}
        for (_, b), n in counts.items():
            best[b] = max(best.get(b, 0), n)
        out = {}
        for k, d in done.items():
            groups, links = d or ([], [])
            text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
            out[k] = (
                sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        return out, counts


@pytest.fixture(scope="module")
def plain():
    return Plain()


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query(spark, data, plain):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    want, _ = plain.rows(texts)
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in entry.queries()["op12_alignment"](spark, data).collect()}
    assert got == want and len(got) == len(texts)


def test_awkward_texts(spark, plain):
    rng = random.Random(12)
    letters = list("aBe'sdll 09  漢字😀é́\xa0\x1c\x85　\n\t\r\v.,<>_�‍ßŁ") + ["<|endoftext|>", "</s>", "<0x0A>", "  ", "\n\n", " the", "ing", "▁", "\0"]
    texts = []
    for i in range(1500):
        of = letters if i % 4 == 0 else letters[:-2] if i % 4 < 3 else list("the cat  \n sat.")
        texts.append((i, "".join(rng.choice(of) for _ in range(rng.randrange(40)))))
    texts += [(2000, None), (2001, ""), (2002, " "), (2003, "  "), (2004, "\n"), (2005, "x " * 3000), (2006, "漢" * 3000), (2007, "a▁b"), (2008, "a ")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    both = Vocabularies(spark, A, B)
    rows = align_tokens(docs, both)
    want, counts = plain.rows(texts)
    assert sum(w[0] > 0 for w in want.values()) > 900
    for r in count_links(rows, both).collect():
        digest = hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, digest) == want[r.doc_id], r.text
    named = named_pairs(pair_counts(rows), both).collect()
    assert {(r.a, r.b): r["count"] for r in named} == dict(counts)


def test_pairs_are_bounded_by_the_vocabularies():
    pair = Pair(*(open(p, "rb").read() for p in (A, B)))
    assert len(pair.codes) <= sum(map(len, pair.a_bytes)) + 2 * sum(map(len, pair.b_bytes)) and pair.by_stretch
    whole = Pair(*(open(p, "rb").read() for p in (A, B)))
    whole.by_stretch = False
    text = "The quick brown fox.\n\n  Jumps é漢 over " * 20
    (parts,), (one,) = pair.align_all([text]), whole.align_all([text])
    assert len(one) == 1 and ";".join(p[2] for p in parts) == one[0][2] and b"".join(p[3] for p in parts) == one[0][3]


def test_words_are_met_again_whatever_follows():
    """A word is cut and remembered once for all marks and line ends behind it."""
    pair = Pair(*(open(p, "rb").read() for p in (A, B)))
    words = [f"{c}{d}zzy" for c in "abcdeéö" for d in "lmnop"]
    text = " ".join(w + mark for w in words for mark in (",", ".", "!?", ";", ":", ")", ".\nThe", "\nSo"))
    pair.align_all([text])
    assert pair.by_word and len(pair.known) < 2 * len(words)


def test_cuts_behind_words_and_marks(plain):
    rng = random.Random(31)
    items = ["The", "it", "'s", "'t", "don", "naïve", "é", "Ö9", "3", ".14", ",", ".", "!!", '"', "(", ")", "***"]
    items += ["<0x0A>", "</s>", "e\u0301", "×", "…", "—", "»", "漢", "😀", "µ", "ª"]
    gaps = ["", "", "", " ", " ", "  ", "\n", "\n\n", " \n ", "\t", "\r\n", "\xa0", "\x0b", "\u2028", "▁"]
    texts = []
    for i in range(3000):
        texts.append("".join(rng.choice(items) + rng.choice(gaps[: -1 if i % 10 else None]) for _ in range(rng.randrange(1, 14))))
    texts += [".", "\n", " ", ",x", "\nx", "'s", "a. ", "a.\n", "a \n", "x,\ny", "a.\n\n b", "x" * 300 + ", y", "," * 300 + " y"]
    pair = Pair(*(open(p, "rb").read() for p in (A, B)))
    assert pair.by_word
    for of in (texts, texts[::-1], *([t] for t in texts[-100:])):
        for text, parts in zip(of, pair.align_all(of)):
            groups, _ = plain.align(text) or ([], [])
            assert ";".join(p[2] for p in parts) == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups), text
            assert sum(p[0] for p in parts) == sum(len(x) for x, _ in groups), text
    # Each part by itself, without the others of its batch.
    for text in texts[:300]:
        pair.known, pair.older = {}, {}
        groups, _ = plain.align(text) or ([], [])
        assert ";".join(p[2] for p in pair.align_all([text])[0]) == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups), text


def test_awkward_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (None, "c", "y"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string").selectExpr("*", "'k' AS verdict", "'k' AS body", "'k' AS n_best")
    both = Vocabularies(spark, A, B)
    out = count_links(align_tokens(docs, both), both)
    got = out.collect()
    assert len(set(out.columns)) == len(out.columns) and all(r.verdict == r.body == "k" for r in got)
    assert sorted(map(str, ((r.doc_id, r.n_links, r.count_sum) for r in got))) == sorted(
        map(str, [(1, 2, 4), (1, 2, 4), (None, 0, 0), (None, 1, 1), (3, 0, 0)])
    )
    assert count_links(align_tokens(docs.filter("false"), both), both).collect() == []
