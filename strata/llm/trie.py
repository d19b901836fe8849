"""Prefix trie of conversations: range-sorted shards finish their own nodes, the nodes on splitter paths are reduced."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import col
from strata.session import Workspace, kept

# Bytes of a turn's digest in a path.
STEP = 16
# Bytes of paths that a shard should hold, sampled conversations per shard, and the most shards and nodes of the splitters' trie.
SHARD_BYTES, SAMPLED, MOST_SHARDS, SKELETON_NODES = 1 << 20, 40, 1 << 15, 1 << 18
# Conversations of a shard, at least, where a table is small.
LEAST_CONVERSATIONS = 32
# Rows of an outgoing batch, and characters of joined ids in one row.
BATCH, RUN_CHARS = 2000, 1 << 16

NODE = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("depth", T.LongType()),
        T.StructField("parent_conv_id", T.LongType()),
        T.StructField("n_convs", T.LongType()),
        T.StructField("n_children", T.LongType()),
        T.StructField("n_leaves", T.LongType()),
        T.StructField("saved_tokens", T.LongType()),
        T.StructField("ends_sha256", T.StringType()),
    ]
)
# Rows of a shard: finished nodes (``above``: the skeleton node over them, if any), and a skeleton node's share (``skeleton``),
# whose joined ids come in runs in the order of (shard, nth).
SHARE = T.StructType([*NODE, *[T.StructField(n, T.LongType()) for n in ("above", "skeleton", "chars", "shard", "nth")], T.StructField("ids", T.StringType())])

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_paths(turns: DataFrame, head: int, every: int, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rebuilt conversations as (conv_id, path, chars): 16 bytes of digest, and the code points of the text, for each turn.

    A conversation c starts with the first h turns of conversation ``c - c % every``, with h = crc32(decimal c) % ``head``, and goes on with
    its own turns after its first h. Turns go by number, those without one first; equal numbers by digest. NULL roles and texts are
    empty; rows without a conversation's id belong to none and are left out. ``head`` 0 takes the conversations as they are.

    Texts are reduced to digests as they are read; turns move once, to the task of their conversation's head.
    """
    spoken, said = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role, text))
    # The length of the role keeps role and text apart.
    digest = F.unhex(F.md5(F.concat(F.octet_length(spoken).cast("string"), F.lit(":"), spoken, said).cast("binary")))
    rows = turns.filter(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("c"),
        F.struct(col(turn).isNotNull().alias("known"), col(turn).alias("turn"), digest.alias("digest"), F.char_length(said).alias("n")).alias("t"),
    )
    rows = rows.withColumn("first", F.col("c") - F.col("c") % every).repartition("first")
    whole = rows.groupBy("first", "c").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    if head:
        heads = whole.filter("c = first").select("first", F.slice("ts", 1, head).alias("hs"))
        h = (F.crc32(F.col("c").cast("string").cast("binary")) % head).cast("int")
        whole = whole.join(heads, "first", "left").withColumn("h", h)
        begin = F.slice(F.coalesce("hs", F.array().cast(whole.schema["ts"].dataType)), F.lit(1), F.col("h"))
        own = F.slice("ts", F.col("h") + 1, F.greatest(F.size("ts") - F.col("h"), F.lit(0)))
        whole = whole.withColumn("ts", F.concat(begin, own))
    path = F.unhex(F.array_join(F.transform("ts", lambda t: F.hex(t["digest"])), ""))
    return whole.select(F.col("c").alias("conv_id"), path.alias("path"), F.transform("ts", lambda t: t["n"]).alias("chars"))


class Splitters:
    """Cuts of the order by (path, conv_id), and the trie of their paths: the nodes that may reach into several shards."""

    def __init__(self, cuts: list[tuple[bytes, int]], most: int = SKELETON_NODES):
        self.cuts = cuts
        while not self._trie(most):
            # Shorter paths are cuts too; conversations that agree that far then stay in one shard.
            depth = max(len(p) for p, _ in self.cuts) // STEP // 2
            self.cuts = sorted({(p, c) if len(p) <= depth * STEP else (p[: depth * STEP], -(2**63)) for p, c in self.cuts})

    def _trie(self, most: int) -> bool:
        """Nodes by their parent's number and their last turn, the root being 0; whether there are few enough."""
        self.nodes: dict[tuple[int, bytes], int] = {}
        self.parents, self.depths = [-1], [0]
        for path, _ in self.cuts:
            at = 0
            for k in range(0, len(path), STEP):
                step = (at, path[k : k + STEP])
                if step not in self.nodes:
                    self.nodes[step] = len(self.parents)
                    self.parents.append(at)
                    self.depths.append(k // STEP + 1)
                    if len(self.parents) > most:
                        return False
                at = self.nodes[step]
        return True


def cut_points(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Up to ``shards - 1`` cuts that deal the conversations out evenly, from a sample by a digest of the id."""
    total = paths.count()
    share = max(1, total // max(1, SAMPLED * shards))
    sample = paths.filter(F.pmod(F.xxhash64("conv_id", F.lit("trie")), F.lit(share)) == 0).select("path", "conv_id")
    # The sample is sorted and thinned where it is; only the cuts come to the driver.
    order = sample.orderBy("path", "conv_id").withColumn("row", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id())
    order = kept(order)
    counts = sorted((r["part"], r["n"], r["first"]) for r in order.groupBy("part").agg(F.count("*").alias("n"), F.min("row").alias("first")).collect())
    picks, seen = [], 0
    n = sum(c for _, c, _ in counts)
    wanted = sorted({n * k // shards for k in range(1, shards)} - {0})
    for _, many, first in counts:
        picks += [first + w - seen for w in wanted if seen <= w < seen + many]
        seen += many
    if not picks:
        return []
    rows = paths.sparkSession.createDataFrame([(p,) for p in picks], "row long")
    return sorted({(bytes(r["path"]), r["conv_id"]) for r in order.join(F.broadcast(rows), "row", "left_semi").collect()})


class _Open:
    """A node whose conversations are being read."""

    __slots__ = ("skeleton", "chars", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "sha", "ids", "n_ids", "nth", "waiting")

    def __init__(self, skeleton: int | None, chars: int):
        self.skeleton, self.chars = skeleton, chars
        self.conv_id, self.n_convs, self.n_children, self.n_leaves, self.saved = 2**63 - 1, 0, 0, 0, 0
        self.sha, self.ids, self.n_ids, self.nth = None, [], 0, 0
        self.waiting: list[tuple] = []


class ShardWalk:
    """Reads a shard's conversations in order of (path, conv_id) and finishes its nodes.

    The nodes on the current path are open. A node that isn't on a splitter's path has all its conversations in the shard and is
    finished when the path leaves it; its children wait for it, to learn its smallest conversation. A node on a splitter's path
    gives its share: what its own members and its finished children add, without its children on splitter paths.
    """

    def __init__(self, shard: int, skeleton: dict[tuple[int, bytes], int]):
        self.shard, self.skeleton = shard, skeleton
        self.path = b""
        self.open: list[_Open] = [_Open(0, 0)]
        self.done: list[tuple] = []

    def add(self, conv_id: int, path: bytes, chars: list[int]) -> None:
        low, high = 0, min(len(self.path), len(path)) // STEP
        if path[: high * STEP] == self.path[: high * STEP]:
            low = high
        while low < high:  # halve down to the first turn that differs
            mid = (low + high + 1) // 2
            if path[: mid * STEP] == self.path[: mid * STEP]:
                low = mid
            else:
                high = mid - 1
        self.close(low)
        self.path = path
        for k in range(low, len(path) // STEP):
            above = self.open[-1].skeleton
            number = None if above is None else self.skeleton.get((above, path[k * STEP : (k + 1) * STEP]))
            self.open.append(_Open(number, chars[k]))
        end = self.open[-1]
        end.n_convs += 1
        end.conv_id = min(end.conv_id, conv_id)
        if end.skeleton is not None:
            end.ids.append(str(conv_id))
            end.n_ids += len(end.ids[-1]) + 1
            if end.n_ids >= RUN_CHARS:
                self._run(end)
        elif end.sha is None:
            end.sha = hashlib.sha256(b"%d" % conv_id)
        else:
            end.sha.update(b",%d" % conv_id)

    def _run(self, node: _Open) -> None:
        self.done.append((*[None] * 9, node.skeleton, None, self.shard, node.nth, ",".join(node.ids)))
        node.ids, node.n_ids = [], 0
        node.nth += 1

    def close(self, depth: int) -> None:
        """Finish the open nodes below a depth."""
        while len(self.open) - 1 > depth:
            node = self.open.pop()
            self._finish(node, len(self.open), self.open[-1])

    def finish(self) -> None:
        self.close(0)
        self._finish(self.open.pop(), 0, None)

    def _finish(self, node: _Open, depth: int, parent: _Open | None) -> None:
        if parent is not None:
            parent.n_convs += node.n_convs
            parent.conv_id = min(parent.conv_id, node.conv_id)
        if node.skeleton is not None:
            if node.ids:
                self._run(node)
            share = (node.conv_id, depth, None, node.n_convs, node.n_children, node.n_leaves, node.saved, None)
            self.done.append((*share, None, node.skeleton, node.chars, self.shard, None, None))
            return
        node.n_leaves = node.n_leaves or 1
        node.saved += (node.n_convs - 1) * node.chars
        parent.n_children += 1
        parent.n_leaves += node.n_leaves
        parent.saved += node.saved
        row = (node.n_convs, node.n_children, node.n_leaves, node.saved, node.sha.hexdigest() if node.sha else EMPTY_SHA)
        nothing = (None, None, self.shard, None, None)
        if parent.skeleton is None:
            parent.waiting.append((node.conv_id, depth, row))
        else:
            self.done.append((node.conv_id, depth, None, *row, parent.skeleton, *nothing))
        for conv_id, below, child in node.waiting:
            self.done.append((conv_id, below, node.conv_id, *child, None, *nothing))


def prefix_trie(paths: DataFrame, shard_bytes: int = SHARD_BYTES, most: int = SKELETON_NODES) -> DataFrame:
    """One row per node of the trie of (conv_id, path, chars): each distinct sequence of first turns.

    ``conv_id`` is the smallest member (conversation that starts so), ``depth``, ``parent_conv_id`` the parent's smallest member, ``n_convs``
    members, ``n_children``, ``n_leaves`` childless nodes in its subtree, ``saved_tokens`` the sum over its subtree of (members - 1)
    times the last text's code points, ``ends_sha256`` a digest of the ids that end there, ascending, joined by commas.

    The conversations are dealt into shards of about ``shard_bytes`` by sampled splitters (path, conv_id), so equal conversations, or many
    with a common beginning, fill as many shards as they need. A node in two shards has a splitter between its conversations and so
    lies on that splitter's path. The trie of those paths (``most`` nodes; beyond that splitters are shortened, which leaves results alone)
    goes to all tasks. Each task walks its sorted shards and finishes all other nodes, in memory that follows one path
    and the children of its open nodes. Shares of splitter nodes are added up by Spark; the driver adds each node's sum to its
    parent's. Joined ids of splitter nodes are hashed in a stream.

    Conversations need distinct ids; those without turns belong to the root. Without conversations there are no nodes.
    """
    spark = paths.sparkSession
    paths = kept(paths.select("conv_id", "path", "chars"))
    size = paths.agg(F.sum(F.octet_length("path") + 4 * F.size("chars") + 16)).first()[0] or 0
    # Small tables are dealt out too, to as many shards as a shuffle has partitions, of some conversations each.
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), paths.count() // LEAST_CONVERSATIONS)
    shards = min(MOST_SHARDS, max(1, least, size // shard_bytes + 1))
    splitters = Splitters(cut_points(paths, shards), most)
    shared = spark.sparkContext.broadcast((splitters.cuts, splitters.nodes))

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        cuts = shared.value[0]
        return pd.Series([bisect_right(cuts, (bytes(p), c)) for p, c in zip(path, conv_id)], dtype="int32")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in SHARE])

        def sent(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        now = None
        for batch in batches:
            for shard, conv_id, path, chars in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now.shard != shard:
                    if now is not None:
                        now.finish()
                        yield sent(now.done)
                    now = ShardWalk(shard, shared.value[1])
                now.add(conv_id, path, chars)
                if len(now.done) >= BATCH:
                    yield sent(now.done)
                    now.done = []
        if now is not None:
            now.finish()
            yield sent(now.done)

    n_shards = len(splitters.cuts) + 1
    dealt = paths.withColumn("shard", shard_of("path", "conv_id")).repartition(n_shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    rows = kept(dealt.select("shard", "conv_id", "path", "chars").mapInArrow(walk, SHARE))
    upper = splitter_nodes(rows, splitters)
    parents = F.broadcast(upper.select(F.col("number").alias("above"), F.col("conv_id").alias("parent")))
    inner = rows.filter("skeleton IS NULL").join(parents, "above", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent"))
    ends = ends_digests(rows.filter("nth IS NOT NULL").select("skeleton", "shard", "nth", "ids"))
    upper = upper.join(ends, F.col("number") == F.col("skeleton"), "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(EMPTY_SHA)))
    return inner.select(NODE.names).unionByName(upper.select(NODE.names))


def splitter_nodes(rows: DataFrame, splitters: Splitters) -> DataFrame:
    """The nodes on splitter paths, from the sums of their shares; there are no more of them than the driver has sent out."""
    shares = rows.filter("skeleton IS NOT NULL AND nth IS NULL").groupBy("skeleton").agg(
        F.min("conv_id"), F.max("chars"), *[F.sum(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    )
    sums = {r[0]: list(r[1:]) for r in shares.collect()}
    # Children have greater numbers than their parents.
    for number in sorted(sums, reverse=True):
        own, above = sums[number], sums.get(splitters.parents[number])
        own[4] = own[4] or 1
        own[5] += (own[2] - 1) * own[1]
        if above is not None:
            above[3] += 1
            above[4] += own[4]
            above[5] += own[5]
    out = []
    for number, (conv_id, _, n_convs, n_children, n_leaves, saved) in sums.items():
        above = sums.get(splitters.parents[number])
        out.append((number, conv_id, splitters.depths[number], above and above[0], n_convs, n_children, n_leaves, saved))
    names = ["number", *NODE.names[:-1]]
    return rows.sparkSession.createDataFrame(out, ", ".join(f"{n} bigint" for n in names))


def ends_digests(runs: DataFrame) -> DataFrame:
    """SHA-256 of each skeleton node's joined ids, whose runs are read in order; nothing but the hash's state is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, out = None, None, []
        for batch in batches:
            for node, ids in zip(batch.column("skeleton").to_pylist(), batch.column("ids")):
                if node != now:
                    if sha is not None:
                        out.append((now, sha.hexdigest()))
                    now, sha = node, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.as_buffer())
        if sha is not None:
            out.append((now, sha.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string()))], names=["skeleton", "sha"])

    return runs.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "nth").mapInArrow(run, "skeleton bigint, sha string")
