"""Near-duplicate documents: fast similarity sketches, banding, and exact verification."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, content, fresh, without
from strata.session import Workspace, kept

OUT = ("n_shingles", "component_id", "kept")
LAST_ID = 2**63 - 1
# Texts and bytes of one side of a tile.
TILE_TEXTS, TILE_BYTES = 500, 8 << 20
# Bytes of text that are hashed at once; that takes about 50 times as much memory.
PIECE_BYTES = 1 << 20

_U = np.uint64
_GOLDEN, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_blank = re.compile(rb"[\x20\x09-\x0D]").search
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Powers of an odd number, for hashes of words by the place of their bytes.
_POWERS = np.cumprod(np.full(1 << 12, 0x5851F42D4C957F2D, dtype=_U))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def shingle_sets(texts: list[str] | list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of many texts, and where each text's begin.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A text with fewer words than ``length`` has
    its whole sequence as one shingle, and none without words. The hashes of a text are sorted.
    """
    raw = [t if isinstance(t, bytes) else t.encode() for t in texts]
    sizes = np.array([len(r) + 1 for r in raw], dtype=np.int64)
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)] if raw else np.zeros(0, np.uint8)
    inside = ~_BLANK[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, _U), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.flatnonzero(inside)
    word_of = np.repeat(np.arange(len(starts)), ends - starts)
    place = at - starts[word_of]
    value = (data[at].astype(_U) + _U(1)) * _POWERS[place & 4095] + mixed((place >> 12).astype(_U))
    first = np.concatenate(([0], np.cumsum(ends - starts)[:-1]))
    word = mixed(np.add.reduceat(value, first) + (ends - starts).astype(_U) * _GOLDEN)
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    counts = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate(([0], np.cumsum(counts)))
    # A shingle at every word that has enough words after it in its text, or at the first word of a short text.
    n_shingles = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
    total = int(n_shingles.sum())
    doc = np.repeat(np.arange(len(texts)), n_shingles)
    offset = np.arange(total) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    head = begin[doc] + offset
    width = np.minimum(counts[doc], length)
    h = width.astype(_U)
    for k in range(length):
        step = mixed(h * _GOLDEN + word[np.minimum(head + k, len(word) - 1)])
        h = np.where(k < width, step, h)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(total, dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(texts)))))


def windows(raw: bytes, length: int, most: int) -> Iterator[bytes]:
    """A long text in parts of about ``most`` bytes, cut between words, each beginning with the last ``length - 1`` words of the one before.

    Every run of ``length`` words lies in one part. A part has at least ``length`` words, unless the text has not.
    """
    start, end = 0, 0
    while end < len(raw):
        blank = _blank(raw, min(len(raw), max(end + 1, start + most)))
        end = blank.start() if blank else len(raw)
        words = raw[start:end].rsplit(None, length - 1) if length > 1 else [raw[start:end]]
        if end == len(raw):
            if start == 0 or len(raw[start:end].split(None, length)) >= length:
                yield raw[start:end]
        elif len(words) == length and words[0].strip():
            yield raw[start:end]
            start = start + len(words[0]) if length > 1 else end


def sets_of(texts: list[str], length: int, most: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingle_sets` in bounded memory: short texts in runs, long ones part by part."""
    hashes, sizes = [], []
    for run in _pieces(texts, most):
        if len(run) == 1 and len(run[0]) > most:
            parts = [shingle_sets([w], length)[0] for w in windows(run[0].encode(), length, most)]
            hashes.append(np.unique(np.concatenate(parts)))
            sizes.append(len(hashes[-1]))
        else:
            h, begin = shingle_sets(run, length)
            hashes.append(h)
            sizes += np.diff(begin).tolist()
    return np.concatenate([np.zeros(0, _U), *hashes]), np.cumsum([0, *sizes])


def fast_sketches(hashes: np.ndarray, begin: np.ndarray, t: int) -> np.ndarray:
    """Sketches of ``t`` coordinates; two sets agree in each with the probability of their similarity.

    In round ``i`` every element of a set falls into a bin and leaves the value of ``i`` and a hash there if
    that is the least so far. In the first ``t`` rounds the bin is hashed too; in round ``t + i`` every
    element falls into bin ``i``. A set stops after the round in which its last bin fills, so every
    coordinate is filled, large sets stop after about ``t log t`` placements, and the rounds keep the
    coordinates nearly independent. A row of zeros stands for an empty set.
    """
    n = len(begin) - 1
    out = np.full(n * t, np.iinfo(_U).max, dtype=_U)
    sizes = np.diff(begin)
    doc = np.repeat(np.arange(n), sizes)
    filled = np.zeros(n, dtype=np.int64)
    elements = hashes
    for i in range(2 * t):
        if not len(elements):
            break
        h = mixed(elements + _U((i + 1) * int(_GOLDEN) & (2**64 - 1)))
        bins = (h % _U(t)).astype(np.int64) if i < t else np.full(len(h), i - t)
        value = (_U(i) << _U(52)) | (mixed(h ^ _M1) >> _U(12))
        np.minimum.at(out, doc * t + bins, value)
        active = np.unique(doc)
        filled[active] = (out.reshape(n, t)[active] != np.iinfo(_U).max).sum(axis=1)
        more = filled[doc] < t
        elements, doc = elements[more], doc[more]
    out = out.reshape(n, t)
    out[sizes == 0] = 0
    return out


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates; the key tells the band too."""
    cut = sketches.reshape(len(sketches), bands, rows)
    h = np.broadcast_to(np.arange(bands, dtype=_U) * _GOLDEN, cut.shape[:2]).copy()
    for r in range(rows):
        h = mixed(h + cut[:, :, r] * _M2)
    return h


def _pieces(series: Iterable[str], most: int = PIECE_BYTES) -> Iterator[list[str]]:
    """The texts of a batch in runs of bounded length, at least one text each."""
    run, size = [], 0
    for t in series:
        if run and size + len(t) > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def sketch_udf(length: int, bands: int, rows: int):
    """Number of shingles, a 128-bit digest of the set, and the band keys of a text."""

    @F.pandas_udf("struct<n:bigint,s1:bigint,s2:bigint,bands:array<bigint>>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        out: dict[str, list] = {"n": [], "s1": [], "s2": [], "bands": []}
        for run in _pieces(texts):
            h, begin = sets_of(run, length)
            keys = band_keys(fast_sketches(h, begin, bands * rows), bands, rows).view(np.int64)
            sums = [np.concatenate((np.zeros(1, _U), np.cumsum(mixed(h ^ m)))) for m in (_M1, _M2)]
            out["n"] += np.diff(begin).tolist()
            for name, total in zip(("s1", "s2"), sums):
                out[name] += (total[begin[1:]] - total[begin[:-1]]).view(np.int64).tolist()
            out["bands"] += list(keys)
        return pd.DataFrame(out)

    return sketch


def alike_udf(length: int, percent: int):
    """Whether the full shingle sets of two texts have the similarity."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            h, begin = sets_of([x, y], length)
            n, m = np.diff(begin)
            common = n + m - len(np.unique(h))
            out.append(bool(100 * common >= percent * (n + m - common)))
        return pd.Series(out, dtype=bool)

    return alike


def tile_links(length: int, percent: int):
    """Links between the components of a tile: each left text against each right one, on full sets."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        left, right = tile[tile["left"]].drop_duplicates("node"), tile[~tile["left"]].drop_duplicates("node")
        h, begin = sets_of(right["text"].tolist(), length)
        n_right, comp_right = np.diff(begin), right["comp"].to_numpy()
        owner = np.repeat(np.arange(len(right)), n_right)
        order = np.argsort(h, kind="stable")
        h, owner = h[order], owner[order]
        joined: dict[int, int] = {}

        def root(x: int) -> int:
            while x in joined:
                x = joined[x]
            return x

        g, at = sets_of(left["text"].tolist(), length)
        for i, comp in enumerate(left["comp"].tolist()):
            own = g[at[i] : at[i + 1]]
            lo, hi = np.searchsorted(h, own), np.searchsorted(h, own, side="right")
            spots = np.repeat(lo - np.concatenate(([0], np.cumsum(hi - lo)[:-1])), hi - lo) + np.arange((hi - lo).sum())
            common = np.bincount(owner[spots], minlength=len(right))
            hit = (100 * common >= percent * (len(own) + n_right - common)) & (comp_right != comp)
            for other in comp_right[hit].tolist():
                a, b = root(comp), root(other)
                if a != b:
                    joined[max(a, b)] = min(a, b)
        return pd.DataFrame({"a": list(joined.values()), "b": list(joined)}, dtype="int64")

    return run


def components(work: Workspace, edges: DataFrame) -> DataFrame:
    """(id, root) of the ids in edges (a, b) whose component has a smaller id; root is the smallest.

    Every end hooks to its smallest smaller neighbour, pointers are doubled until they reach the roots,
    and the edges between different roots go on. Tables shrink from round to round and stay distributed.
    """
    edges = work.stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    total = None
    while not edges.isEmpty():
        hook = work.stage(edges.groupBy("b").agg(F.min("a").alias("p")))
        while True:
            up = hook.select(F.col("b").alias("b2"), F.col("p").alias("p2"))
            step = hook.join(up, F.col("p") == F.col("b2"), "left")
            longer = work.stage(step.select("b", F.coalesce("p2", "p").alias("p"), F.col("p2").isNotNull().alias("moved")))
            hook = longer.drop("moved")
            if longer.filter("moved").isEmpty():
                break
        if total is None:
            total = hook
        else:
            up = hook.select(F.col("b").alias("b2"), F.col("p").alias("p2"))
            old = total.join(up, F.col("p") == F.col("b2"), "left").select("b", F.coalesce("p2", "p").alias("p"))
            total = work.stage(old.unionByName(hook))
        for end in ("a", "b"):
            up = hook.select(F.col("b").alias("b2"), F.col("p").alias("p2"))
            edges = edges.join(up, F.col(end) == F.col("b2"), "left").withColumn(end, F.coalesce("p2", end)).drop("b2", "p2")
        edges = work.stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    if total is None:
        return edges.select(F.col("b").alias("id"), F.col("a").alias("root"))
    return total.select(F.col("b").alias("id"), F.col("p").alias("root"))


def relabelled(work: Workspace, labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, comp) after joining the components of links (a, b)."""
    roots = components(work, links)
    return work.stage(
        labels.join(roots, F.col("comp") == F.col("id"), "left").select("node", F.coalesce("root", "comp").alias("comp"))
    )


def _mixed_buckets(work: Workspace, entries: DataFrame, labels: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Entries with their components, and per bucket with more than one its largest component and a pivot from it."""
    entries = work.stage(entries.join(labels, "node"))
    per = entries.groupBy("key", "comp").agg(
        F.count("*").alias("m"), F.sum("size").alias("bytes"), F.min(F.struct(F.xxhash64("node", F.lit(turn)), F.col("node").alias("node"))).alias("one")
    )
    buckets = (
        per.groupBy("key")
        .agg(
            F.count("*").alias("n_comps"),
            F.sum("m").alias("members"),
            F.sum("bytes").alias("bytes"),
            F.max(F.struct("m", "comp", F.col("one")["node"].alias("pivot"))).alias("top"),
        )
        .filter("n_comps > 1")
        .select("key", "members", "bytes", F.col("top")["comp"].alias("main"), F.col("top")["pivot"].alias("pivot"))
    )
    return entries, work.stage(buckets)


def near_links(
    work: Workspace, texts: DataFrame, entries: DataFrame, length: int, percent: int, turns: int
) -> DataFrame:
    """Labels (node, comp) of the nodes in buckets: components of all links among texts that share a bucket.

    First some turns in which each text outside its buckets' largest components is compared with one pivot,
    the one it shares most buckets with. That joins most of a large group without pairs inside it.
    Then every pair that shares a bucket and is still in different components, but for those within the
    largest, is compared in tiles of bounded size, which return links only.
    """
    alike = alike_udf(length, percent)
    labels = work.stage(entries.select("node").distinct().select("node", F.col("node").alias("comp")))
    tried = None
    for turn in range(turns):
        placed, buckets = _mixed_buckets(work, entries, labels, turn)
        pairs = placed.join(buckets, "key").filter("comp != main").groupBy("node", "pivot").agg(F.count("*").alias("shared"))
        if tried is not None:
            pairs = pairs.join(tried, ["node", "pivot"], "left_anti")
        pairs = work.stage(pairs.groupBy("node").agg(F.max(F.struct("shared", "pivot"))["pivot"].alias("pivot")))
        left = pairs.join(texts, "node").withColumnRenamed("text", "left")
        both = left.join(texts.select(F.col("node").alias("pivot"), F.col("text").alias("right")), "pivot")
        links = work.stage(both.filter(alike("left", "right")).select("node", "pivot"))
        if links.isEmpty():
            break
        tried = work.stage(pairs if tried is None else tried.unionByName(pairs))
        ends = links.join(labels, "node").withColumnRenamed("comp", "a")
        ends = ends.join(labels.select(F.col("node").alias("pivot"), F.col("comp").alias("b")), "pivot")
        labels = relabelled(work, labels, ends.select("a", "b"))
    placed, buckets = _mixed_buckets(work, entries, labels, turns)
    blocks = F.greatest(F.ceil(F.col("members") / TILE_TEXTS), F.ceil(F.col("bytes") / TILE_BYTES)).cast("int")
    rows = placed.join(buckets, "key").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    right = rows.select("key", "node", "comp", F.explode(every).alias("i"), F.col("block").alias("j"), F.lit(False).alias("left"))
    left = rows.filter("comp != main").select("key", "node", "comp", F.col("block").alias("i"), F.explode(every).alias("j"), F.lit(True).alias("left"))
    tiles = right.unionByName(left).join(texts, "node")
    links = tiles.groupBy("key", "i", "j").applyInPandas(tile_links(length, percent), "a long, b long")
    return relabelled(work, labels, work.stage(links))


def near_dedup(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 50,
    rows: int = 7,
    turns: int = 3,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """All rows with ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``.

    Documents are linked if ``percent`` of the union of their sets of word shingles is common. Documents
    with the same set are one class, told by a 128-bit digest; the classes are sketched, those that
    agree in a band become candidates, and every link is confirmed on full sets. With 50 bands of 7 coordinates a link
    of exactly 0.8 becomes a candidate with probability 1 - 8e-6, a closer one with more.

    NULL and empty texts and texts without words are linked with nothing. Rows that repeat an id count as
    one document, whose texts are linked. A row without an id is a document of its own, after all others; a component of
    such rows only keeps the one whose text has the least digest, the first one read of equal texts. Columns of the input
    named like an added one are replaced.
    """
    spark = docs.sparkSession
    docs = without(docs, OUT)
    k, th, row, first, found_k, found_th = fresh(docs, "k", "th", "row", "first", "found_k", "found_th")
    ident, digest = F.coalesce(col(id).cast("bigint"), F.lit(LAST_ID)), F.xxhash64(content(text))
    # Rows without an id are numbered once, so that one of equal texts can stay.
    loose = kept(docs.filter(col(id).isNull()).withColumn(row, F.monotonically_increasing_id()))
    with Workspace(spark, "near") as work:
        base = docs.select(ident.alias("k"), content(text).alias("text"))
        sketched = base.select("k", F.xxhash64("text").alias("th"), F.octet_length("text").alias("size"), sketch_udf(shingle, bands, rows)("text").alias("s"))
        sketched = work.stage(sketched.select("k", "th", "size", "s.*"))
        full = sketched.filter("n > 0")
        # A class has a number of its own, because ids may be missing or shared; ``one`` is its first text.
        classes = full.groupBy("s1", "s2").agg(
            F.min(F.struct("k", "th")).alias("one"), F.first("size").alias("size"), F.first("bands").alias("bands")
        )
        classes = work.stage(classes.withColumn("node", F.monotonically_increasing_id()))
        entries = classes.select("node", "size", F.explode("bands").alias("key"))
        shared = entries.groupBy("key").count().filter("count > 1").select("key")
        entries = work.stage(entries.join(shared, "key", "left_semi"))
        wanted = classes.select("node", "one.*").join(entries.select("node").distinct(), "node", "left_semi")
        texts = base.withColumn("th", F.xxhash64("text")).join(wanted, ["k", "th"])
        texts = work.stage(texts.select("node", "text").dropDuplicates(["node"]))
        labels = near_links(work, texts, entries, shingle, percent, turns)
        nodes = classes.select("s1", "s2", "one", "node").join(labels, "node", "left")
        nodes = work.stage(nodes.select("s1", "s2", "one", F.coalesce("comp", "node").alias("comp")))
        # The texts of a repeated id are linked.
        sets = F.struct("s1", "s2")
        again = full.filter(F.col("k") != LAST_ID).groupBy("k").agg(F.min(sets).alias("low"), F.max(sets).alias("high")).filter("low != high")
        ends = full.join(again.select("k"), "k", "left_semi").join(nodes, ["s1", "s2"]).select("k", "comp").distinct()
        ends = work.stage(ends)
        links = ends.join(ends.groupBy("k").agg(F.min("comp").alias("a")), "k").select("a", F.col("comp").alias("b"))
        roots = components(work, links)
        nodes = nodes.join(roots, F.col("comp") == F.col("id"), "left").select("s1", "s2", "one", F.coalesce("root", "comp").alias("comp"))
        nodes = work.stage(nodes)
        tops = nodes.groupBy("comp").agg(F.min("one").alias("top"))
        nodes = work.stage(nodes.join(tops, "comp").select("s1", "s2", "top"))
        firsts = loose.groupBy(digest.alias("th")).agg(F.min(row).alias("first")).withColumn("k", F.lit(LAST_ID))
        found = sketched.select("k", "th", "n", "s1", "s2").join(nodes, ["s1", "s2"], "left").dropDuplicates(["k", "th"])
        found = found.join(firsts, ["k", "th"], "left")
        found = kept(
            found.select(
                F.col("k").alias(found_k),
                F.col("th").alias(found_th),
                F.col("n").alias("n_shingles"),
                F.when(F.col("n") > 0, F.col("top")["k"]).otherwise(F.col("k")).alias("component_id"),
                F.when(F.col("n") == 0, -1).when((F.col("top")["k"] == LAST_ID) & (F.col("top")["th"] == F.col("th")), F.col("first")).alias(first),
            )
        )
    out = docs.filter(col(id).isNotNull()).withColumn(row, F.lit(None).cast("bigint")).unionByName(loose)
    out = out.withColumn(k, ident).withColumn(th, digest).join(found, (F.col(k) == F.col(found_k)) & (F.col(th) == F.col(found_th)))
    component = F.nullif(F.col("component_id"), F.lit(LAST_ID))
    # Without an id: texts without words stay, of the others the keeper of a component that has no id.
    stays = F.coalesce((F.col(first) == -1) | (F.col(first) == F.col(row)), F.lit(False))
    return out.select(
        *[col(c) for c in docs.columns],
        "n_shingles",
        component.alias("component_id"),
        F.when(col(id).isNull(), stays).otherwise(col(id).eqNullSafe(component)).alias("kept"),
    )
