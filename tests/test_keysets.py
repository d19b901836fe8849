"""The search for keys against trying all column sets."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from strata.operators import keysets
from strata.operators.profile import candidate_keys


def brute(rows, width):
    for size in range(1, width + 1):
        found = [s for s in combinations(range(width), size) if len({tuple(r[i] for i in s) for r in rows}) == len(rows)]
        if found:
            return found
    return []


@pytest.fixture()
def passes(monkeypatch):
    """Counts the passes over a table."""
    count = []
    for name in ("find_agreements", "exact_agreement"):
        inner = getattr(keysets, name)
        monkeypatch.setattr(keysets, name, lambda *a, inner=inner, name=name, **k: (count.append(name), inner(*a, **k))[1])
    return count


@pytest.mark.parametrize("seed", range(8))
def test_random_tables(spark, monkeypatch, seed):
    rng = random.Random(seed)
    if seed % 2:  # parts of the hash values first, then larger ones
        monkeypatch.setattr(keysets, "MOVED", 50)
        monkeypatch.setattr(keysets, "ZOOM", 3)
    width, n = rng.randrange(2, 7), rng.choice([1, 2, 12, 60])
    rows = [tuple(rng.randrange(rng.choice([2, 3, 5])) for _ in range(width)) for _ in range(n)]
    if seed % 3:
        rows = list(dict.fromkeys(rows))
    df = spark.createDataFrame(rows, ", ".join(f"c{i} int" for i in range(width)))
    want = [tuple(f"c{i}" for i in s) for s in brute(rows, width)]
    assert keysets.smallest_keys(df, df.columns, len(rows)) == sorted(want)


def test_five_of_thirty_columns(spark, passes):
    """The key is five columns of eight values; the others are coarser or depend on few of them."""
    rng = random.Random(5)
    parts = [F.floor(F.col("id") / 8**k) % 8 for k in range(5)]
    others = [(rng.randrange(5), rng.randrange(5), rng.choice([2, 3, 4, 5])) for _ in range(25)]
    columns = [p.alias(f"k{i}") for i, p in enumerate(parts)]
    columns += [F.pmod(F.xxhash64(parts[a], parts[b], F.lit(i)), F.lit(m)).alias(f"x{i}") for i, (a, b, m) in enumerate(others)]
    rng.shuffle(columns)
    df = spark.range(8**5).select(*columns).cache()
    found = keysets.smallest_keys(df, df.columns, 8**5)
    df.unpersist()
    assert [set(s) for s in found] == [{"k0", "k1", "k2", "k3", "k4"}] and len(passes) < 40


def test_a_value_that_most_rows_have(spark, passes):
    df = spark.range(20_000).selectExpr("IF(id % 3 = 0, id, -1) AS a", "id % 20000 AS b", "1 AS c", "CAST(id AS string) AS d")
    assert candidate_keys(df).collect() == [("b", 1, 20_000), ("d", 1, 20_000)]
    assert candidate_keys(df, columns=["a", "c"]).collect() == [] and len(passes) < 10


def test_lattice():
    lattice = keysets.Lattice(4)
    assert list(lattice.open_sets(1)) == [1, 2, 4, 8]
    lattice.agree([0b0011, 0b0111, 0b1000, 0b1000])
    assert sorted(lattice.agreements) == [0b0111, 0b1000]
    assert list(lattice.open_sets(1)) == [] and sorted(lattice.open_sets(2)) == [0b1001, 0b1010, 0b1100]
