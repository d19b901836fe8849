"""Row-wise comparison of versions by bucket sums, against grouping everything."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.operators.audit import audit_compare, audit_except, differing_buckets

SCHEMA = "a int, b string, c double, m map<string,int>, l array<int>"


def some_rows(rng, n):
    return [
        (rng.choice([None, 1, 2]), rng.choice([None, "1", "x"]), rng.choice([None, 0.0, -0.0, float("nan")]), rng.choice([None, {"k": 1}]), rng.choice([None, [1, 2], []]))
        for _ in range(n)
    ]


def plain(a, b):
    """The multiset difference by counting."""
    key = lambda r: (r[0], r[1], None if r[2] is None else "nan" if r[2] != r[2] else r[2] + 0.0, None if r[3] is None else tuple(r[3].items()), None if r[4] is None else tuple(r[4]))
    x, y = Counter(map(key, a)), Counter(map(key, b))
    return Counter({("a_only", *k): n for k, n in (x - y).items()} | {("b_only", *k): n for k, n in (y - x).items()})


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
def test_random_versions(spark, buckets):
    rng = random.Random(buckets)
    a = some_rows(rng, 300)
    b = rng.sample(a, 290) + some_rows(rng, 15)
    # Maps cannot be grouped; without them all other types are.
    x, y = (spark.createDataFrame(r, SCHEMA).drop("m") for r in (a, b))
    got = {}
    for r in audit_except(x, y, buckets).collect():
        c = None if r.c is None else "nan" if r.c != r.c else r.c + 0.0
        got[(r.side, r.a, r.b, c, None, None if r.l is None else tuple(r.l))] = r.n_rows
    strip = lambda rows: [(*r[:3], None, r[4]) for r in rows]
    assert got == dict(plain(strip(a), strip(b)))


def test_equal_versions_move_one_row_a_bucket(spark, plan):
    rows = some_rows(random.Random(1), 500)
    a = spark.createDataFrame(rows, SCHEMA)
    b = spark.createDataFrame(rows[::-1], SCHEMA).select("l", "m", "c", "b", "a")
    signed = a.withColumn("s", F.lit(1)).unionByName(b.withColumn("s", F.lit(-1)))
    assert differing_buckets(signed, a.columns, "s").count() == 0
    assert differing_buckets(signed.filter("s = 1 OR a IS NULL OR a > 1"), a.columns, "s").count() > 0
    assert audit_except(a.drop("m"), b.drop("m")).count() == 0


def test_values_that_change_places_with_null(spark):
    a, b = spark.createDataFrame([(None, 1)], "x int, y int"), spark.createDataFrame([(1, None)], "x int, y int")
    assert {(r.side, r.x, r.y, r.n_rows) for r in audit_except(a, b).collect()} == {("a_only", None, 1, 1), ("b_only", 1, None, 1)}


def compared(a, b):
    """What audit_compare tells, row by row."""
    out = Counter()
    sides = [defaultdict(list), defaultdict(list)]
    for side, rows in zip(sides, (a, b)):
        for r in rows:
            side[r[0]].append(r)
    for k in sides[0].keys() | sides[1].keys():
        x, y = sides[0].get(k, []), sides[1].get(k, [])
        if len(x) > 1 or len(y) > 1:
            out["*", "key_not_unique"] += 1
        elif not x or not y:
            out["*", "b_only" if not x else "a_only"] += 1
        else:
            out["*", "matched"] += 1
            for c, u, v in (("b", x[0][1], y[0][1]), ("c", x[0][2], y[0][2])):
                kind = "both_null" if u is None and v is None else "null_in_a" if u is None else "null_in_b" if v is None else "equal" if u == v else "different"
                out[c, kind] += 1
    return out


@pytest.mark.parametrize("buckets", [1, 13, 1 << 16])
def test_values_are_compared_by_key(spark, buckets):
    rng = random.Random(buckets)
    row = lambda k: (k, rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]))
    a = [row(rng.choice([None, *range(200)])) for _ in range(90)] + [row(k) for k in range(300, 500)]
    b = [r if rng.random() < 0.9 else row(r[0]) for r in a if rng.random() < 0.95] + [row(k) for k in range(600, 605)]
    x, y = (spark.createDataFrame(r, "k int, b string, c int") for r in (a, b))
    got = {(r.column_name, r.outcome): r.n_rows for r in audit_compare(x.withColumn("extra", F.lit(1)), y, "k", buckets).collect()}
    assert got.pop(("extra", "only_in_a")) == len({r[0] for r in a})
    assert {k: n for k, n in got.items() if n} == dict(compared(a, b)) and len(got) == 4 + 2 * 5
