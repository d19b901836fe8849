"""Byte-level BPE encoding and decoding with a rank queue on a hierarchical bitmap."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import col, content, fresh, without

OUT = ("n_tokens", "ids")
# Pre-tokens of at most so many bytes are remembered by a worker, in two halves of so much memory each.
CACHED_BYTES, CACHE_BYTES = 48, 80 << 20
# What an entry of a dictionary takes besides its text and its ids.
ENTRY_BYTES = 190
SLICE_BYTES = 2 << 20


_BIT = [1 << i for i in range(256)]


class Coder(dict):
    """Ranks, pattern and remembered pre-tokens of one vocabulary; maps a pre-token to its packed ids.

    The rank queue holds positions in one bucket per merge rank. A bit of the lower bitmap, in words of
    256 ranks, says that a rank's bucket has entries; a bit of the upper one, that a lower word has bits.
    Two find-first-set steps reach the lowest rank, so an operation costs the same however long the
    pre-token is. Buckets are heaps, so that of equal ranks the leftmost goes first.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.older: dict[str, bytes] = {}
        self.used = 0
        self.single = [ranks.get(bytes((b,))) for b in range(256)]
        self.double = [ranks.get(bytes((a, b))) for a in range(256) for b in range(256)]
        # Empty between pre-tokens, so they are made once.
        self.buckets: dict[int, list[int]] = {}
        self.lower = [0] * ((max(ranks.values(), default=0) >> 8) + 1)
        # White space as Unicode has it; the pattern's \s would also take four separators.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: merge the lowest-ranked adjacent pair until no pair has a rank.

        Parts are a linked list over byte positions; a part's id is the rank at which it was merged. An entry of
        the queue is stale, and skipped, when the pair at its position has another rank by now or is gone.
        """
        rank_of, buckets, lower, upper, n = self.ranks.get, self.buckets, self.lower, 0, len(piece)
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        ids = [self.single[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n))
        double = self.double
        current = [double[a << 8 | b] for a, b in zip(piece, piece[1:])]
        current.append(None)
        for i, rank in enumerate(current):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)  # ascending, which is a heap
                else:
                    buckets[rank] = [i]
                    lower[rank >> 8] |= _BIT[rank & 255]
                    upper |= 1 << (rank >> 8)
        while upper:
            word = (upper & -upper).bit_length() - 1
            bits = lower[word]
            rank = (word << 8) | ((bits & -bits).bit_length() - 1)
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                lower[word] = bits = bits & (bits - 1)
                if not bits:
                    upper &= upper - 1
            if current[i] != rank:
                continue
            gone = after[i]
            after[i] = end = after[gone]
            current[gone] = current[i] = ids[gone] = None
            ids[i] = rank
            before[end] = i
            if end < n:
                rank = rank_of(piece[i : after[end]])
                if rank is not None:
                    current[i] = rank
                    if rank in buckets:
                        heappush(buckets[rank], i)
                    else:
                        buckets[rank] = [i]
                        lower[rank >> 8] |= _BIT[rank & 255]
                        upper |= 1 << (rank >> 8)
            if i:
                left = before[i]
                current[left] = rank = rank_of(piece[left:end])
                if rank is not None:
                    if rank in buckets:
                        heappush(buckets[rank], left)
                    else:
                        buckets[rank] = [left]
                        lower[rank >> 8] |= _BIT[rank & 255]
                        upper |= 1 << (rank >> 8)
        return [i for i in ids if i is not None]

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            raw = piece.encode()
            ids = self.merge(raw)
            packed = struct.pack(f"<{len(ids)}I", *ids)
            if len(raw) > CACHED_BYTES:
                return packed
        self.used += ENTRY_BYTES + len(piece) + len(packed)
        if self.used > CACHE_BYTES:
            # What was used since the last time is found again in the older half.
            self.older = self.copy()
            self.clear()
            self.used = ENTRY_BYTES + len(piece) + len(packed)
        self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


_coders: dict[bytes, Coder] = {}


def _coder(shared: Broadcast, pattern: str) -> Coder:
    """The coder of a vocabulary file's content, made once in a worker."""
    data = shared.value
    key = hashlib.md5(data + pattern.encode()).digest()
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(parse_ranks(data), pattern)
    return _coders[key]


class Bpe:
    """One vocabulary, ready for use in tasks. The file is read by the driver and has a fixed size; workers get its content."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            self.shared = spark.sparkContext.broadcast(f.read())
        self.pattern = pattern

    def decode(self, packed: Column) -> Column:
        shared, pattern = self.shared, self.pattern

        @F.pandas_udf("binary")
        def decode(packed: pd.Series) -> pd.Series:
            return packed.map(_coder(shared, pattern).decode)

        return decode(packed)


def unpack(packed: Column) -> Column:
    """Packed ids as an array of integers."""

    @F.pandas_udf("array<int>")
    def unpack(packed: pd.Series) -> pd.Series:
        return packed.map(lambda p: np.frombuffer(p, "<u4").astype("i4"))

    return unpack(packed)


def bpe_encode(
    docs: DataFrame, bpe: Bpe, text: str = "text", carry: Sequence[str] | None = None, decoded: bool = False
) -> DataFrame:
    """All rows with ``n_tokens`` and ``ids``, little-endian unsigned 32-bit integers in a binary.

    Every match of the pattern is encoded separately; text that looks like a special token is text. Texts are
    encoded whole, and results leave the worker in slices of about ``SLICE_BYTES``, so that memory does not follow
    the size of a batch. ``carry`` names the input columns to keep (default: all); ``decoded`` adds the bytes that the
    ids stand for. NULL and empty texts have no ids. Columns of the input named like an added one are replaced.
    """
    added = [*OUT, *(["decoded"] if decoded else [])]
    docs = without(docs, added)
    carried = [c for c in docs.columns if carry is None or c in carry]
    (body,) = fresh(docs, "body")
    shared, pattern = bpe.shared, bpe.pattern
    source = docs.select(*[col(c) for c in carried], content(text).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            done = 0
            while done < len(texts):
                ids, size, start = [], 0, done
                while done < len(texts) and size < SLICE_BYTES:
                    ids.append(coder.encode(texts[done].as_py()))
                    size += len(ids[-1])
                    done += 1
                columns = [c.slice(start, done - start) for c in batch.columns[:-1]]
                columns += [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array([coder.decode(i) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, *added])

    schema = T.StructType([docs.schema[c] for c in carried]).add("n_tokens", T.LongType()).add("ids", T.BinaryType())
    return source.mapInArrow(run, schema.add("decoded", T.BinaryType()) if decoded else schema)


def bpe_decode(encoded: DataFrame, bpe: Bpe, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All rows with the bytes that packed ``ids`` stand for; NULL ids give no bytes."""
    return without(encoded, (out,)).withColumn(out, bpe.decode(F.coalesce(col(ids), F.lit(b""))))

