"""K-d tree partitioning into shards of nearly equal bytes."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import col, content, fresh, without
from strata.session import Workspace

OUT = ("shard", "slot")
# Histogram bins of a node in one pass.
BINS = 1024
# Words of a code stay so small that differences of two fit a long.
LIMIT = 2**61
# Bytes of text that one word holds, and words of a text that are compared as they are; of longer ones hashes decide.
WORD_BYTES, TEXT_WORDS = 7, 8


def payload(text: str) -> Column:
    """UTF-8 bytes of the text (NULL: none) plus 16 for the row."""
    return (F.octet_length(content(text)) + 16).cast("bigint")


def is_text(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def code(df: DataFrame, name: str, longest: int = 0) -> list[Column]:
    """A column as whole numbers that compare in its order, one after the other; NULL first.

    Numbers beyond ``LIMIT`` go on in a second word, fractions in another. Texts (and what else is taken as text) are words of
    ``WORD_BYTES`` bytes for as many bytes as the ``longest`` has; of texts with more than ``TEXT_WORDS`` words, two hashes follow in place
    of the rest, so rows are told apart whatever their texts have in common.
    """
    kind, c = df.schema[name].dataType, col(name)
    low, high = F.lit(-LIMIT), F.lit(LIMIT)
    if isinstance(kind, T.DecimalType):
        large = F.lit(10**18).cast("decimal(38,0)")
        whole = F.floor(c).cast("decimal(38,0)")
        top = F.floor(whole / large).cast("decimal(38,0)")
        words = [top.cast("bigint")] if kind.precision - kind.scale > 18 else []
        words.append((whole - top * large).cast("bigint") if words else whole.cast("bigint"))
        if kind.scale:
            # Up to 18 digits of the fraction tell rows apart.
            words.append(((c - whole) * F.lit(10 ** min(kind.scale, 18)).cast("decimal(19,0)")).cast("bigint"))
    elif isinstance(kind, T.FractionalType):
        value = F.nanvl(c.cast("double"), F.lit(float("inf")))
        inside = F.greatest(F.least(value, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))
        beyond = F.when(value == float("inf"), LIMIT).when(value == -float("inf"), -LIMIT).otherwise((F.signum(value) * F.log2(F.abs(value)) * 2**40).cast("bigint"))
        words = [F.floor(inside).cast("bigint"), F.when(F.abs(value) > LIMIT, beyond).otherwise(((value - F.floor(inside)) * 2**52).cast("bigint"))]
    elif isinstance(kind, T.NumericType):
        value = c.cast("bigint")
        inside = F.greatest(F.least(value, high), low)
        words = [inside, value - inside] if isinstance(kind, T.LongType) else [value]
    elif not is_text(kind):
        words = [F.unix_micros(c.cast("timestamp"))]
    else:
        raw = c.cast("string").cast("binary")
        n = -(-longest // WORD_BYTES)
        parts = [F.rpad(F.hex(F.substring(raw, 1 + i * WORD_BYTES, WORD_BYTES)), 2 * WORD_BYTES, "0") for i in range(min(n, TEXT_WORDS))]
        words = [F.conv(p, 16, 10).cast("bigint") for p in parts] or [F.when(c.isNotNull(), 0).cast("bigint")]
        if n > TEXT_WORDS:
            words += [F.shiftright(F.xxhash64(raw, F.lit(i)), 2) for i in (1, 2)]
    return [F.coalesce(w, F.lit(-LIMIT - 1)) for w in words]


def measure(df: DataFrame, name: str, first: Column) -> Column:
    """What a dimension's width is told by: numbers as they are, the beginnings of texts."""
    return F.coalesce(col(name).cast("double") if isinstance(df.schema[name].dataType, T.NumericType) else first.cast("double"), F.lit(0.0))


def listed(values: Sequence[Sequence[int]], at: Column) -> Column:
    """``values[at]`` of a list of lists that the plan carries as one constant; it has an entry per shard at most."""
    text = json.dumps([list(v) for v in values])
    return F.get(F.from_json(F.lit(text), "array<array<bigint>>"), at)


def look(values: Sequence[int], at: Column) -> Column:
    """``values[at]`` of a list, likewise."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>"), at)


@dataclass
class Cut:
    """A node of one level: how many shards it becomes, and which rows go left: those whose code in a dimension is not above the limit."""

    leaves: int
    first: int = 0  # its left child's number in the next level
    dim: int = 0
    limit: tuple[int, ...] = (2**62,)


class Tree:
    """Levels of cuts. A row walks down with one expression over the levels, whatever their number."""

    def __init__(self, leaves: int):
        self.done: list[list[Cut]] = []
        self.level = [Cut(leaves)]

    def place(self, df: DataFrame, codes: Column, node: str) -> DataFrame:
        """The node of each row, from its codes per dimension."""
        if not self.done:
            return df.withColumn(node, F.lit(0))
        cuts = [n for level in self.done for n in level]
        starts = [sum(map(len, self.done[:i])) for i in range(len(self.done))]

        def step(at: Column, start: Column) -> Column:
            cut = start + at
            own = F.get(codes, look([n.dim for n in cuts], cut).cast("int"))
            right = own > listed([n.limit for n in cuts], cut)
            return (look([n.first for n in cuts], cut) + right.cast("int")).cast("int")

        return df.withColumn(node, F.aggregate(F.array(*map(F.lit, starts)), F.lit(0), step))

    def descend(self) -> None:
        below: list[Cut] = []
        for n in self.level:
            n.first = len(below)
            below += [Cut(1)] if n.leaves == 1 else [Cut(n.leaves // 2), Cut(n.leaves - n.leaves // 2)]
        self.done.append(self.level)
        self.level = below


def _crossing(rows: DataFrame, pick: Column, low: list[int], high: list[int], goal: list[float]) -> tuple[list[int], list[float]]:
    """Per node the value at which the running weight reaches the goal, and the weight below it.

    Each pass counts one histogram for all nodes, finds on the executors the bin in which each node's goal lies, and narrows the
    node to that bin's values; the driver gets a row per node and pass.
    """
    low, high, below = list(low), list(high), [0.0] * len(low)
    while any(a < b for a, b in zip(low, high)):
        at = F.col("node")
        a, b = look(low, at), look(high, at)
        inside = rows.select("node", "size", pick.alias("v")).filter((a < b) & F.col("v").between(a, b))
        bin = F.floor((F.col("v") - a).cast("double") * BINS / (b - a + 1).cast("double"))
        bins = inside.groupBy("node", bin.alias("bin")).agg(F.sum("size").alias("w"), F.min("v").alias("a"), F.max("v").alias("b"))
        # Weights are whole, so the goal may be rounded up.
        wanted = look([math.ceil(g - w) for g, w in zip(goal, below)], at)
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bin"))
        last = F.lead("bin").over(Window.partitionBy("node").orderBy("bin")).isNull()
        # The bin in which the goal is reached, or the last one where all weight is below it.
        hit = bins.withColumns({"upto": upto, "last": last, "reached": upto >= wanted}).filter("reached OR last")
        for r in hit.groupBy("node").agg(F.min(F.struct("bin", "a", "b", "w", "upto", "reached")).alias("x")).select("node", "x.*").collect():
            n = r["node"]
            below[n] += r["upto"] - r["w"]
            low[n], high[n] = (r["a"], r["b"]) if r["reached"] else (r["b"], r["b"])
    return low, below


def plan_tree(
    docs: DataFrame, dims: Sequence[str], id: str, text: str, leaves: int | None = None, target_bytes: int | None = None
) -> tuple[Tree, list[list[Column]]]:
    """Split recursively at weighted medians along each node's widest dimension.

    Width is a node's range as a part of the whole table's range. A node that becomes ``k`` shards
    is cut at ``floor(k / 2) / k`` of its bytes; rows with the cut's value are cut by id. Codes are compared word by word: where
    a word's cut falls among rows that share it, the next word is cut.
    """
    texts = [c for c in dict.fromkeys([*dims, id]) if is_text(docs.schema[c].dataType)]
    longest = dict.fromkeys(texts, 0)
    if texts:
        sizes = docs.agg(*[F.max(F.octet_length(col(c).cast("string"))) for c in texts]).first()
        longest = {c: n or 0 for c, n in zip(texts, sizes)}
    tie = code(docs, id, longest.get(id, 0))
    codes = [[*code(docs, d, longest.get(d, 0)), *tie] for d in dims]
    names, n_words = [f"d{i}" for i in range(len(dims))], max(map(len, codes))
    with Workspace(docs.sparkSession, "shards") as work:
        rows = work.stage(
            docs.select(
                *[F.array(*c).alias(n) for c, n in zip(codes, names)],
                *[measure(docs, d, c[0]).alias(f"m_{n}") for d, c, n in zip(dims, codes, names)],
                payload(text).alias("size"),
            )
        )
        if leaves is None:
            total = rows.agg(F.sum("size")).first()[0] or 0
            leaves = max(1, -(-total // target_bytes))
        tree, whole = Tree(leaves), None
        while any(n.leaves > 1 for n in tree.level):
            placed = tree.place(rows, F.array(*names), "node")
            ranges = [f(f"m_{c}").alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]
            seen = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("size").alias("w"), *ranges).collect()}
            if not seen:
                break
            whole = whole or seen[0]
            goal = [0.0] * len(tree.level)
            for i, n in enumerate(tree.level):
                if n.leaves > 1 and i in seen:
                    width = [(seen[i][f"max_{c}"] - seen[i][f"min_{c}"]) / ((whole[f"max_{c}"] - whole[f"min_{c}"]) or 1.0) for c in names]
                    n.dim = width.index(max(width))
                    goal[i] = seen[i]["w"] * (n.leaves // 2) / n.leaves
            own = F.get(F.array(*names), look([n.dim for n in tree.level], F.col("node")).cast("int"))
            _cut_words(tree, placed.select("node", "size", own.alias("own")), goal, n_words)
            tree.descend()
    return tree, codes


def _cut_words(tree: Tree, rows: DataFrame, goal: list[float], n_words: int) -> None:
    """The limits of a level's nodes, word by word; only rows that share the words at the cut so far go on."""
    nodes = [i for i, g in enumerate(goal) if g > 0]
    limit: dict[int, list[int]] = {n: [] for n in nodes}
    at, left = F.col("node"), rows.filter(look([int(g > 0) for g in goal], F.col("node")) == 1)
    for j in range(n_words):
        word = F.get("own", F.lit(j))
        # Where the cut has been found all remaining words are those of one row, or of rows that share an id.
        spans = left.filter(word.isNotNull()).groupBy("node").agg(F.min(word).alias("a"), F.max(word).alias("b"), F.sum("size").alias("w")).collect()
        if not spans:
            break
        low, high = [0] * len(goal), [0] * len(goal)
        for r in spans:
            low[r["node"]], high[r["node"]] = r["a"], r["b"]
        value, below = _crossing(left, word, low, high, goal)
        for r in spans:
            n = r["node"]
            limit[n].append(value[n])
            goal[n] -= below[n]
        left = left.filter(word == look(value, at))
    if not limit:
        return
    edges = [limit.get(n, []) for n in range(len(goal))]
    held = rows.filter(F.col("own") == listed(edges, at)).groupBy("node").agg(F.sum("size").alias("w")).collect()
    weight = {r["node"]: r["w"] for r in held}
    for n, words in limit.items():
        # What shares all words goes where it leaves the smaller difference.
        tree.level[n].limit = (*words[:-1], words[-1] - (2 * goal[n] < weight.get(n, 0)))


def kd_shards(
    docs: DataFrame,
    dims: Sequence[str],
    leaves: int | None = None,
    target_bytes: int | None = None,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """All rows with ``shard`` (from 0) and ``slot`` (gapless from 0 within the shard, in id order, then by length and digest).

    Give the number of shards or the bytes each should reach. Ids and dimensions may be of any type that can be cast to text. The
    tree has one entry per shard and stays in the plan; the rows themselves are only read, and move once, for the slots.

    NULL text has no bytes, NULL in a dimension sorts first. Rows that repeat an id stay together where a cut
    falls on them. An empty table gives no rows. Columns of the input named like an added one are replaced.
    """
    docs = without(docs, OUT)
    tree, codes = plan_tree(docs, dims, id, text, leaves, target_bytes)
    node, own = fresh(docs, "node", "own")
    coded = docs.withColumn(own, F.array(*[F.array(*c) for c in codes]))
    order = Window.partitionBy("shard").orderBy(col(id), F.octet_length(content(text)), F.xxhash64(content(text)))
    return (
        tree.place(coded, col(own), node)
        .select(*[col(c) for c in docs.columns], F.col(node).alias("shard"))
        .withColumn("slot", (F.row_number().over(order) - 1).cast("bigint"))
    )


def write_shards(shards: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order."""
    shards.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
