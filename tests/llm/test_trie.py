"""The conversation trie against a plain version with dictionaries of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from strata.llm.trie import Splitters, prefix_trie, turn_paths

NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn int, role string, text string"


def rebuilt(rows, head=6, every=100):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    if not head:
        return turns
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % head
        out[c] = turns.get(c - c % every, [])[:h] + own[h:]
    return out


def plain(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def got(df):
    rows = [tuple(r[n] for n in NAMES) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(-1 if x is None else x for x in r))


def in_order(rows):
    return sorted(rows, key=lambda r: tuple(-1 if x is None else x for x in r))


def conversations(rng, n):
    rows, texts = [], ["", "a", "bb", "ünï", "😀"]
    # Turns of one number have no order of their own, so there are none.
    for c in rng.sample(range(3, 600), n):
        for turn in range(rng.randrange(1, 8)):
            rows.append((c, turn, rng.choice(["user", "bot"]), rng.choice(texts[: rng.randrange(1, 6)])))
    return rows


def test_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(entry.queries()["op11_trie"](spark, data)) == in_order(plain(rebuilt(rows)))


@pytest.mark.parametrize("shard_bytes, most", [(1 << 30, 1000), (300, 1 << 18), (300, 12), (50, 2)])
def test_random(spark, shard_bytes, most):
    rng = random.Random(shard_bytes + most)
    rows = conversations(rng, 150)
    # A third of all conversations is the same, and some are long.
    rows += [(c, k, "user", "same") for c in range(1000, 1080) for k in range(5)]
    rows += [(c, k, "user", str(k) if k < 150 + c else "end") for c in range(3) for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(prefix_trie(turn_paths(df, 6, 100), shard_bytes, most)) == in_order(plain(rebuilt(rows)))
    assert got(prefix_trie(turn_paths(df, 0, 100), shard_bytes, most)) == in_order(plain(rebuilt(rows, head=0)))


def test_awkward_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "a", "x"), (0, None, "a", "z"), (1, 3, "a", "x"), (1, 3, "a", "x"), (100, 2, "ab", "c"), (101, 2, "a", "bc"),
        (None, 1, "a", "lost"), (205, 1, None, ""), (207, 9, "", None), (-5, 1, "a", "minus"), (300, 1, "u", "long " * 100_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'k' AS c", "'k' AS path", "7 AS first")
    kept = [r for r in rows if r[0] is None or r[0] >= 0]
    assert got(prefix_trie(turn_paths(df.filter("conv_id IS NULL OR conv_id >= 0"), 6, 100))) == in_order(plain(rebuilt(kept)))
    assert len(got(prefix_trie(turn_paths(df, 6, 100)))) > 0
    assert prefix_trie(turn_paths(df.filter("conv_id IS NULL"), 6, 100)).collect() == []


def test_splitters_are_bounded():
    cuts = sorted((bytes([k]) * 16 * 400, k) for k in range(50))
    assert len(Splitters(cuts, 10_000).parents) <= 10_000 and len(Splitters(cuts, 5).cuts) >= 1
    assert len(Splitters(cuts, 1 << 20).parents) == 1 + 50 * 400
