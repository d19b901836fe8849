"""Best-fit packing of tokenised documents: large pieces matched in pairs, small ones best-fit into the gaps."""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from strata.llm.common import col, content, fresh, without
from strata.session import kept

PIECE = ("piece", "start", "length", "ids")
OUT = ("sequence_id", "offset")
# Memory of the words that a worker remembers, characters that are encoded at once, and bytes of ids that leave at once.
CACHE_BYTES, CHUNK, SLICE_BYTES = 256 << 20, 1 << 20, 1 << 20
# What a remembered word takes besides its ids.
ENTRY_BYTES = 200
# Pieces of one length are numbered in cells of about so many.
CELL = 300

_blank = re.compile(r"[ \t\n\r]").search
# Latin letters and digits, composed, whose small forms are one letter and the same whatever stands around them.
_LATIN = "0-9A-Za-zªµºÀ-ÖØ-öø-įıĲ-ɏ"
_beyond_latin = re.compile("[^\x00-įıĲ-ɏ]").search
_mark_run = re.compile(rf"[.,](?<=[^ {_LATIN}][.,]) ").search
_mark = re.compile(rf"(?<=[{_LATIN}])(?=[.,] )")


def _latin_1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def plain_words_only(config: dict) -> Tokenizer | None:
    """The tokenizer of a file, for words of small composed letters alone: without what such words pass unchanged.

    None if the file does anything else to them than compose, squeeze blanks and lower, and take runs of letters as bytes.
    """
    kinds = [n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", [])]
    before = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    runs = len(before) == 2 and before[0]["type"] == "Split" and r"|[\p{L}]+|" in before[0]["pattern"].get("Regex", "")
    if kinds != ["NFC", "Replace", "Lowercase"] or not runs or before[1]["type"] != "ByteLevel" or not config["model"].get("end_of_word_suffix"):
        return None
    splits = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, before[1]]}
    return Tokenizer.from_str(json.dumps(config | {"normalizer": None, "pre_tokenizer": splits, "added_tokens": []}))


class WordIds:
    """Ids of texts by a vocabulary that drops white space and case; words are encoded once and remembered.

    White space ends every token of such a vocabulary, and so does a full stop or comma after a Latin letter or digit, so the ids of a text are
    those of its words in a row. Words new to the worker are encoded together, and the tokens' character offsets
    say whose they are. The newer half of what is remembered is ``known``; when it is full, the older half is dropped.
    """

    def __init__(self, data: bytes):
        self.tokenizer = Tokenizer.from_str(data.decode())
        config = json.loads(data)
        self.plain = plain_words_only(config)
        suffix = config["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.used = 0

    def spaced(self, text: str) -> str:
        """A text with a space between words, which are written alike where the vocabulary takes them to be."""
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        if "<" not in text or not any(t in text or t.lower() in text.lower() for t in self.special):
            if _latin_1(text) or not _beyond_latin(text):
                text = text.lower()
            text = _mark.sub(" ", text) if _mark_run(text) else text.replace(". ", " . ").replace(", ", " , ")
        return text

    def learn(self, words: list[str]) -> None:
        """Remember the ids of new words. Words of small letters are one run each, which ends with a token that ends a word."""
        easy = [w for w in words if w.isalpha() and w == w.lower() and _latin_1(w)] if self.plain else []
        if easy:
            ids = np.array(self.plain.encode_batch_fast([" ".join(easy)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(easy):
                self._remember(easy, ids, np.concatenate(([0], cuts)))
                words = set(words).difference(easy)
        if words:
            words = sorted(words)
            starts = np.cumsum([0, *[len(w) + 1 for w in words]])
            encoded = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            firsts = np.array([a for a, _ in encoded.offsets], dtype=np.int64)
            self._remember(words, np.array(encoded.ids, dtype="<u4"), np.searchsorted(firsts, starts))

    def _remember(self, words: list[str], ids: np.ndarray, cuts: np.ndarray) -> None:
        packed, at = ids.tobytes(), (4 * cuts).tolist()
        self.known.update((w, packed[a:b]) for w, a, b in zip(words, at, at[1:]))
        self.used += ENTRY_BYTES * len(words) + len(packed)

    def known_ids(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        out = list(map(self.known.get, words))
        new = [w for w, ids in zip(words, out) if ids is None]
        if new:
            again = {w: ids for w in new if (ids := self.older.get(w)) is not None}
            self.known |= again
            self.used += ENTRY_BYTES * len(again)
            self.learn([w for w in new if w not in again])
            out = list(map(self.known.__getitem__, words))
        if self.used > CACHE_BYTES // 2:
            self.older, self.known, self.used = self.known, {}, 0
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, without special tokens around the texts.

        Words are split and made distinct column-wise, distinct ones are looked up, and their ids are put in place by number.
        """
        lists = pc.split_pattern(pa.array([self.spaced(t) for t in texts], pa.large_string()), " ")
        words = lists.flatten().dictionary_encode()
        which = words.indices.to_numpy()
        found = self.known_ids(words.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.array([len(f) for f in found], dtype=np.int64) // 4
        starts = np.cumsum(sizes) - sizes
        many = sizes[which]
        ends = np.cumsum(many)
        flat = ids[np.repeat(starts[which] - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate(([0], ends))[lists.offsets.to_numpy()].tolist()
        return [flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def encode(self, text: str) -> bytes:
        return b"".join(self.encode_all([part])[0] for part in chunks(text))


def chunks(text: str) -> Iterator[str]:
    """A text in parts of about ``CHUNK`` characters, cut at blanks."""
    at = 0
    while at < len(text):
        cut = _blank(text, at + CHUNK)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def _encoded(encoder: WordIds, texts: pa.Array) -> Iterator[tuple[int, bytes]]:
    """The ids of each text of a column; short texts are encoded together, long ones part by part."""
    run, size, first = [], 0, 0
    for i in range(len(texts)):
        text = texts[i].as_py()
        if run and size + len(text) > CHUNK:
            yield from enumerate(encoder.encode_all(run), first)
            run, size = [], 0
        if len(text) > CHUNK:
            yield i, encoder.encode(text)
            continue
        if not run:
            first = i
        run.append(text)
        size += len(text)
    if run:
        yield from enumerate(encoder.encode_all(run), first)


_encoders: dict[bytes, WordIds] = {}


def _encoder(shared: Broadcast) -> WordIds:
    """The encoder of a vocabulary file's content, made once in a worker."""
    key = hashlib.md5(shared.value).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordIds(shared.value)
    return _encoders[key]


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end: int = 0, text: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """The documents' ids and the id ``end``, cut into pieces of at most ``capacity``: ``piece``, ``start``, ``length``, ``ids``.

    ``vocabulary`` is a file of a tokenizer that drops white space; it has a fixed size and goes to the workers by
    broadcast. ``ids`` are little-endian unsigned 32-bit integers. Only documents longer than ``capacity`` have several pieces, and
    only the last one is shorter. NULL and empty texts are one piece of the end id; rows that repeat are documents of their
    own. ``carry`` names the input columns to keep (default: all). Columns of the input named like an added one are replaced.
    Texts are encoded whole, in runs cut at blanks, so memory follows the longest text and not the batch.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    docs = without(docs, PIECE)
    carried = [c for c in docs.columns if carry is None or c in carry]
    (body,) = fresh(docs, "body")
    last = np.array([end], dtype="<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            rows, pieces, ids, size = [], [], [], 0
            for i, packed in _encoded(encoder, batch.column(batch.num_columns - 1)):
                packed += last
                for k, at in enumerate(range(0, len(packed), step)):
                    rows.append(i)
                    pieces.append(k)
                    ids.append(packed[at : at + step])
                    size += len(ids[-1])
                    if size >= SLICE_BYTES:
                        yield _slice(batch, rows, pieces, ids)
                        rows, pieces, ids, size = [], [], [], 0
            if rows:
                yield _slice(batch, rows, pieces, ids)

    def _slice(batch: pa.RecordBatch, rows: list[int], pieces: list[int], ids: list[bytes]) -> pa.RecordBatch:
        at = pa.array(rows, pa.int64())
        columns = [c.take(at) for c in batch.columns[:-1]]
        columns += [pa.array(pieces, pa.int32()), pa.array([k * capacity for k in pieces], pa.int64())]
        columns += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=[*carried, *PIECE])

    schema = T.StructType([docs.schema[c] for c in carried]).add("piece", T.IntegerType()).add("start", T.LongType())
    schema = schema.add("length", T.LongType()).add("ids", T.BinaryType())
    return docs.select(*[col(c) for c in carried], content(text).alias(body)).mapInArrow(run, schema)


def packing_plan(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces go, from the number of pieces of each length: entries (length, rank, bins, per_bin, sequence, offset).

    An entry puts ``bins * per_bin`` pieces of a length, from the rank on, into as many sequences from ``sequence`` on,
    ``per_bin`` side by side from ``offset`` on.

    Pieces above a third of the capacity are at most two in a sequence. From the longest on, each is matched with the longest other
    one that fits beside it; fits are nested (what fits beside a longer piece fits beside a shorter one), so that gives as many pairs as
    possible. The other pieces, from the longest on, go into the smallest gap that holds them, and into a new sequence if
    none does. All pieces of a length that meet gaps of a size move in one step, so time and entries
    follow the number of lengths, not of pieces: a gap at least halves whenever it is filled, and each length
    splits at most one run of sequences.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    rank = dict.fromkeys(left, 0)
    entries: list[tuple[int, int, int, int, int, int]] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of (first sequence, number of sequences)
    gaps: list[int] = []  # the gaps that have runs, ascending
    sequences = 0

    def put(length: int, bins: int, per_bin: int, sequence: int, offset: int) -> None:
        entries.append((length, rank[length], bins, per_bin, sequence, offset))
        rank[length] += bins * per_bin
        left[length] -= bins * per_bin

    def leave(gap: int, sequence: int, bins: int) -> None:
        if gap and bins:
            if gap not in runs:
                runs[gap] = []
                insort(gaps, gap)
            runs[gap].append((sequence, bins))

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        at = bisect_left(large, min(length, capacity - length) + 1) - 1
        while left[length]:
            while at >= 0 and (left[large[at]] == 0 or (large[at] == length and left[length] < 2)):
                at -= 1
            if at < 0:
                bins, other = left[length], None
            elif large[at] == length:
                bins, other = left[length] // 2, length
            else:
                bins, other = min(left[length], left[large[at]]), large[at]
            put(length, bins, 2 if other == length else 1, sequences, 0)
            if other is not None and other != length:
                put(other, bins, 1, sequences, length)
            leave(capacity - length - (other or 0), sequences, bins)
            sequences += bins

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                sequence, bins = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[at]
            else:
                gap, sequence, bins = capacity, sequences, -(-left[length] // (capacity // length))
                sequences += bins
            per_bin = gap // length
            filled = min(bins, left[length] // per_bin)
            if not filled:
                filled, per_bin = 1, left[length]
            put(length, filled, per_bin, sequence, capacity - gap)
            leave(gap - per_bin * length, sequence, filled)
            leave(gap, sequence + filled, bins - filled)
    return entries


def pack_pieces(pieces: DataFrame, capacity: int = 2048, length: str = "length") -> DataFrame:
    """All rows with ``sequence_id`` and ``offset``: sequences of at most ``capacity``, gapless from 0, as few as best fit gives.

    The driver sees one count per length (at most ``capacity``) and plans with those; the plan goes back by broadcast and has a few
    entries per length. Pieces of a length are alike to the plan: they are numbered in cells of about ``CELL`` pieces, so a length
    that many pieces share is spread over many tasks, and a cell looks up its part of the plan. Rows move once. They are checkpointed
    first, so every count and number is of the same rows, whatever is lost on the way.

    Repeated rows are pieces of their own, NULL or impossible lengths an error. Columns of the input named like an added one are replaced.
    """
    pieces = without(pieces, OUT)
    size, row, bucket, nth, base, places, n_buckets = fresh(pieces, "size", "row", "bucket", "nth", "base", "places", "n_buckets")
    rows = kept(pieces.withColumns({size: col(length).cast("int"), row: F.monotonically_increasing_id()}))
    spark = pieces.sparkSession
    counts = {r[size]: r["count"] for r in rows.groupBy(size).count().collect()}
    if None in counts:
        raise ValueError("a piece has no length")
    by_length: dict[int, list[tuple[int, int, int, int, int]]] = {n: [] for n in counts}
    for n, first, bins, per_bin, sequence, offset in packing_plan(counts, capacity):
        by_length[n].append((first, first + bins * per_bin, per_bin, sequence, offset))
    entry = "array<struct<first:bigint,last:bigint,per_bin:int,sequence:bigint,offset:bigint>>"
    plan = spark.createDataFrame(
        [(n, -(-counts[n] // CELL), e) for n, e in by_length.items()], f"{size} int, {n_buckets} bigint, {places} {entry}"
    )
    spread = rows.join(F.broadcast(plan.drop(places)), size).withColumn(bucket, F.pmod(F.xxhash64(row), col(n_buckets))).drop(n_buckets)
    in_order = Window.partitionBy(size).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    cells = spread.groupBy(size, bucket).count().withColumn(base, F.coalesce(F.sum("count").over(in_order), F.lit(0)))
    # A cell keeps the entries that reach into its numbers.
    cells = cells.join(F.broadcast(plan.drop(n_buckets)), size).select(
        size,
        bucket,
        base,
        F.filter(places, lambda e: (e["last"] > col(base)) & (e["first"] < col(base) + F.col("count"))).alias(places),
    )
    number = F.row_number().over(Window.partitionBy(size, bucket).orderBy(row)) - 1
    placed = spread.withColumn(nth, number).join(cells, [size, bucket]).withColumn(nth, col(nth) + col(base))
    placed = placed.withColumn(places, F.filter(places, lambda e: (e["first"] <= col(nth)) & (col(nth) < e["last"]))[0])
    past = col(nth) - col(places)["first"]
    return placed.select(
        *[col(c) for c in pieces.columns],
        (col(places)["sequence"] + F.floor(past / col(places)["per_bin"])).alias("sequence_id"),
        (col(places)["offset"] + (past % col(places)["per_bin"]) * col(size)).alias("offset"),
    )
