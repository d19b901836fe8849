"""Search for the smallest sets of columns that identify every row, on the lattice of column sets.

A set is not unique if two rows agree on it. Pairs of rows that agree prune upward: every subset of the columns they agree on is
ruled out at once. What is left are sets that reach outside of all such agreements; the smallest of them are tested
in batches, each test gives new agreements or a key, and a key prunes everything above it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sets tested in one pass, rows that one pass may move (or, of a small table, so many times its rows), agreements kept of each
# set, and how often a set is tested in a pass that has room.
BATCH, MOVED, TIMES, WITNESSES, COPIES = 400, 2_000_000, 4, 30, 8
# A set without an agreement among one of so many hash values is looked at again among more of them.
ZOOM = 64


class Lattice:
    """What is known of the sets of ``width`` columns. Sets are bit masks."""

    def __init__(self, width: int):
        self.width, self.full = width, (1 << width) - 1
        self.agreements: list[int] = []  # largest sets that some two rows agree on
        self.keys: set[int] = set()

    def agree(self, found: Sequence[int]) -> None:
        """Add sets that rows agree on; of nested ones only the largest matter."""
        known = sorted({*self.agreements, *found}, key=lambda s: -s.bit_count())
        kept: list[int] = []
        for s in known:
            if not any(s & k == s for k in kept):
                kept.append(s)
        self.agreements = kept

    def open_sets(self, size: int) -> Iterator[int]:
        """Sets of ``size`` columns that lie inside no agreement, each once, if all smaller sets lie inside one.

        Such a set must reach outside of every agreement. From a set that lies inside one, the search branches over the columns
        outside of that agreement; a column that was branched on before is closed to the later branches.
        """
        yield from self._grow(0, 0, size)

    def _grow(self, chosen: int, closed: int, left: int) -> Iterator[int]:
        inside = next((a for a in self.agreements if chosen & a == chosen), 0 if left else None)
        if inside is None:
            yield chosen
        elif left:
            outside = self.full & ~inside & ~chosen & ~closed
            while outside:
                bit = outside & -outside
                outside ^= bit
                yield from self._grow(chosen | bit, closed, left - 1)
                closed |= bit


def _set_hash(hashes: Sequence[Column], members: int) -> Column:
    """Hash of a row's values in a set: its columns' hashes, each salted by its column, combined bitwise."""
    out = F.lit(0).cast("bigint")
    for i, h in enumerate(hashes):
        if members >> i & 1:
            out = out.bitwiseXOR(h)
    return out


def find_agreements(rows: DataFrame, width: int, sets: Sequence[int], share: int, copies: int = 1) -> dict[int, list[int]]:
    """For each set that some rows agree on, sets of all columns that two such rows agree on; one pass.

    Rows are taken whose hash of a set falls into one of ``share`` parts, all rows of the same values together, and are grouped by
    that hash before they move, so values that many rows have are no load. Of a group two rows are compared, and two
    that agree on a few more columns, which differ from set to set and from copy to copy. A hash that
    two different values share shows as an agreement that doesn't hold the set, and is left out.
    """
    hashes = [F.col("h")[i] for i in range(width)]
    slots = F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.xxhash64(_set_hash(hashes, sets[k % len(sets)])).alias("v"))
            for k in range(copies * len(sets))
        ]
    )
    inside = F.filter(slots, lambda x: F.pmod(x["v"], F.lit(share)) == 0) if share > 1 else slots
    start = F.pmod(F.col("x.k") * 7, F.lit(width))
    turned = F.concat(F.slice("h", start + 1, F.lit(width)), F.slice("h", F.lit(1), start))
    more = F.xxhash64(F.slice("t", 1, min(3, width)))
    pair = [F.count("*").alias("n"), F.min("t").alias("low"), F.max("t").alias("high")]
    close = rows.select("h", F.explode(inside).alias("x")).select("x.*", turned.alias("t")).groupBy("k", "v", more.alias("more")).agg(*pair)
    far = close.groupBy("k", "v").agg(F.count("*").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    groups = close.select(far.columns).unionByName(far).filter("n > 1")
    same = F.transform(F.arrays_zip("low", "high"), lambda p: F.when(p["low"] == p["high"], "1").otherwise("0"))
    found = groups.select((F.col("k") % len(sets)).alias("s"), F.pmod(F.col("k") * 7, F.lit(width)).alias("start"), F.array_join(same, "").alias("same")).distinct()
    ones = F.length(F.replace("same", F.lit("0"), F.lit("")))
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("s").orderBy(ones.desc(), "same", "start"))).filter(F.col("place") <= WITNESSES)
    out: dict[int, list[int]] = {}
    for r in best.select("s", "start", "same").collect():
        mask = sum(1 << (r["start"] + i) % width for i, c in enumerate(r["same"]) if c == "1")
        if mask & sets[r["s"]] == sets[r["s"]]:
            out.setdefault(sets[r["s"]], []).append(mask)
    return out


def exact_agreement(rows: DataFrame, names: Sequence[str], members: int) -> int | None:
    """The columns that two rows with the same values in a set agree on; None if there are none, so that it is a key.

    Rows whose hashes differ have different values, so the narrow hashes decide for a key; only where some are equal are
    values compared.
    """
    width = len(names)
    narrow = rows.groupBy(_set_hash([F.col("h")[i] for i in range(width)], members).alias("v")).count()
    if narrow.filter("count > 1").isEmpty():
        return None
    keys = [F.col(f"`c{i}`") for i in range(width) if members >> i & 1]
    same = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("h").alias("low"), F.max("h").alias("high")).filter("n > 1")
    found = same.select("low", "high").first()
    if found is None:
        return None
    return members | sum(1 << i for i in range(width) if found["low"][i] == found["high"][i])


def smallest_keys(df: DataFrame, columns: Sequence[str], n: int, most: int | None = None) -> list[tuple[str, ...]]:
    """All sets of the fewest columns (at most ``most``) without NULLs whose values tell any two of the ``n`` rows apart.

    Each pass over the table tests up to ``BATCH`` sets. It looks at so small a share of their hash values that about ``MOVED`` rows move, or ``TIMES`` those of a small table;
    sets that show no agreement there are looked at again in larger shares while they stay open, and what is still open in the
    end is decided by its values. Only agreements reach the driver, a few for each tested set.
    """
    names = list(columns)
    width = len(names)
    if not n or not width:
        return []
    values = [F.col(f"`{c}`") for c in names]
    rows = df.select(*[v.alias(f"c{i}") for i, v in enumerate(values)], F.array(*[F.xxhash64(F.lit(i), v) for i, v in enumerate(values)]).alias("h"))
    lattice, shares = Lattice(width), {}
    if n > 1:
        whole = exact_agreement(rows, names, lattice.full)
        if whole is not None:
            return []
    size = 1
    while size <= min(width, most or width):
        fresh, seen = [], []
        for s in lattice.open_sets(size):
            if s not in lattice.keys:
                (seen if s in shares else fresh).append(s)
                if len(fresh) == BATCH:
                    break
        if fresh:
            tested, copies = fresh, max(1, min(COPIES, BATCH // len(fresh)))
            share = max(1, n * len(fresh) * copies // min(MOVED, TIMES * n))
        elif seen:
            # Those that were looked at least go first, as many as one pass can take.
            seen.sort(key=lambda s: (-shares[s], s))
            last, copies = shares[seen[0]], 1
            share = last // ZOOM
            tested = [s for s in seen if shares[s] == last][: max(1, MOVED * share // n)]
        elif lattice.keys:
            break
        else:
            size += 1
            continue
        if share:
            agreed = find_agreements(rows, width, tested, share, copies)
            lattice.agree([a for found in agreed.values() for a in found])
            shares |= dict.fromkeys(tested, share)
        elif (agreement := exact_agreement(rows, names, tested[0])) is None:
            lattice.keys.add(tested[0])
        else:
            lattice.agree([agreement])
    return sorted(tuple(c for i, c in enumerate(names) if k >> i & 1) for k in lattice.keys)
