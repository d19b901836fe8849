"""Exact copies, near copies and lines against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm.exact import exact_dedup
from strata.llm.lines import line_dedup
from strata.llm.minhash import near_dedup, sets_of, shingle_sets


def sets(texts, length):
    out = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + length]) for k in range(len(w) - length + 1)} or ({tuple(w)} if w else set())
    return out


def linked(texts, length, percent=80):
    s, parent = sets(texts, length), {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in s:
        for b in s:
            common = len(s[a] & s[b])
            if a < b and common and 100 * common >= percent * (len(s[a]) + len(s[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in texts}


@pytest.fixture(scope="module")
def families():
    """Copies of a few texts with more or fewer words replaced: similarities on both sides of the bound."""
    rng = random.Random(5)
    texts = {}
    for family in range(4):
        base = [f"w{rng.randrange(400)}" for _ in range(120)]
        for _ in range(40):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 9])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
            texts[len(texts)] = " ".join(words)
    texts |= {200: None, 201: "", 202: "one TWO", 203: "One two", 204: " \n", 205: "one two three four five six"}
    return texts


@pytest.mark.parametrize("length", [4, 5])
def test_near_dedup(spark, families, length):
    docs = spark.createDataFrame(list(families.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup(docs, shingle=length).collect()}
    assert got == linked(families, length)
    assert all(r.kept == (r.doc_id == r.component_id) for r in near_dedup(docs, shingle=length).collect())


def test_near_dedup_in_small_tiles(spark, families, monkeypatch):
    monkeypatch.setattr("strata.llm.minhash.TILE_TEXTS", 7)
    docs = spark.createDataFrame(list(families.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup(docs, shingle=4, turns=0).collect()}
    assert got == {i: c for i, (_, c) in linked(families, 4).items()}


def test_shingles_of_long_words():
    a, begin = shingle_sets(["x" * 10_000 + " a b c", "x" * 9_999 + "y a b c", "X" * 10_000 + "\ta\nb c"], 4)
    assert begin.tolist() == [0, 1, 2, 3] and a[0] == a[2] != a[1]


def test_exact_dedup(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "A", "a ", "", None, "b" * 50, f"t{i % 40}"])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = {i: (max(groups[t or ""]), len(groups[t or ""])) for i, t in rows}
    weak = lambda c: F.substring(F.unhex(F.sha2(c.cast("binary"), 256)), 1, 1)
    for options in ({}, {"hot_share": 3}, {"salts": 2}, {"digest": weak}, {"digest": weak, "hot_share": 3}):
        got = exact_dedup(docs, **options).collect()
        assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == want and len(got) == len(rows), options
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def test_line_dedup(spark):
    rng = random.Random(3)
    sizes = [5, 15, 16, 17, 24, 63, 64, 65, 66, 127, 128, 129, 130, 200]
    base = ["".join(rng.choice("abc é") for _ in range(rng.choice(sizes))) for _ in range(25)]

    def edit(x):
        i, kind = rng.randrange(len(x) + 1), rng.randrange(4)
        return [x[:i] + rng.choice("abcz") + x[i:], x[:i] + x[i + 1 :], x[:i] + rng.choice("abcz") + x[i + 1 :], x][kind]

    docs = []
    for d in range(60):
        lines = [rng.choice(base) for _ in range(rng.randrange(6))]
        docs.append((d, "\n".join(edit(edit(x)) if rng.random() < 0.3 else edit(x) for x in lines)))
    docs += [(100, None), (101, ""), (5, docs[5][1]), (None, docs[7][1]), (102, "x" * 300 + "\n" + "x" * 301 + "\n" + "x" * 303)]
    seen, want = [], {}
    for d, t in sorted({(-1 if d is None else d, t or "") for d, t in docs}):
        stay = []
        for line in t.split("\n"):
            counts = len(line) >= 16 and line.strip(" ")
            if not counts or not any(within_one(line, o) for o in seen):
                stay.append(line)
            if counts:
                seen.append(line)
        want[d, t] = "\n".join(stay)
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("before", F.coalesce("text", F.lit("")))
    got = line_dedup(frame).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.text == want[-1 if r.doc_id is None else r.doc_id, r.before]
        assert r.n_lines - r.n_dropped == (r.text.count("\n") + 1 if r.text or r.n_dropped < r.n_lines else 0)


def test_line_dedup_needs_long_lines(spark):
    with pytest.raises(ValueError):
        line_dedup(spark.createDataFrame([], "doc_id long, text string"), least_chars=4)


@pytest.mark.parametrize("added", [".", "\r"])
def test_lines_with_a_character_behind_a_whole_chunk(spark, added):
    rng = random.Random(8)
    for first, second in (("", added), (added, "")):
        lines = {n: "".join(rng.choice("abcdefg") for _ in range(n)) for n in (63, 64, 65, 127, 128, 129, 192)}
        docs = [(n, x + first) for n, x in lines.items()] + [(1000 + n, x + second) for n, x in lines.items()]
        got = {r.doc_id: r.n_dropped for r in line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
        assert got == {d: int(d > 1000) for d, _ in docs}


def test_short_lines_if_asked_for(spark):
    rng = random.Random(11)
    docs = [(d, "\n".join("".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(18))) for _ in range(4))) for d in range(60)]
    docs += [(100 + d, "\n".join(x[:p] + c + x[p + k :] for x in docs[d][1].split("\n"))) for d, (p, c, k) in enumerate([(0, "", 0), (3, "z", 0), (5, "", 1), (7, "z", 1)] * 10)]
    seen, want = [], {}
    for d, t in docs:
        want[d] = 0
        for line in t.split("\n"):
            if line.strip(" "):
                want[d] += any(within_one(line, o) for o in seen)
                seen.append(line)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in line_dedup(frame, short_lines=True).collect()} == want
    assert sum(r.n_dropped for r in line_dedup(frame).collect()) < sum(want.values())


def test_near_dedup_of_repeated_and_missing_ids(spark):
    rng = random.Random(21)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(100)) for _ in range(5))
    near = lambda t: t + " more"
    rows = [(10, a), (10, b), (20, near(a)), (30, near(b)), (5, near(b) + " yet"), (7, c)]
    rows += [(None, near(c)), (None, d), (None, d), (None, near(d)), (None, e), (None, ""), (None, None)]
    for parts in (1, 4):
        got = near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        by = {(r.doc_id, r.text): (r.component_id, r.kept) for r in got}
        assert len(got) == len(rows)
        assert all(by[x] == (5, x[0] == 5) for x in rows[:5]) and by[7, c] == (7, True) and by[None, near(c)] == (7, False)
        assert sum(r.kept for r in got if r.text in (d, near(d))) == 1 and by[None, e] == by[None, ""] == by[None, None] == (None, True)


def test_sets_of_long_texts():
    """Window by window the sets are those of the whole text."""
    rng = random.Random(21)
    for case in range(400):
        words = ["".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 3, 40]))) for _ in range(rng.randrange(60))]
        texts = [rng.choice(["", " ", "\n\t"]) + "".join(w + rng.choice([" ", "\n", "  ", "\x0b "]) for w in words), "a b c d e", "", "é " * 30, " "]
        length, most = rng.randrange(1, 7), rng.choice([5, 20, 64])
        (h, at), (g, end) = sets_of(texts, length, most), shingle_sets(texts, length)
        assert at.tolist() == end.tolist()
        assert all(sorted(h[a:b]) == sorted(g[a:b]) for a, b in zip(at, at[1:]))
