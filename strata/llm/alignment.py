"""Cross-tokenizer alignment: tokenizers' offsets and sentencepiece's spans as coarse cuts, refined by the tokens' bytes."""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from strata.llm.common import col, content, fresh, without
from strata.session import kept

ALIGNED = ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")
COUNTED = ("n_best", "count_sum")
# Stretches of at most so many characters are remembered, in so much memory; characters of short texts that are aligned at once.
KNOWN_CHARS, CACHE_BYTES, CHUNK = 64, 256 << 20, 1 << 18
# What a remembered stretch takes besides its texts and codes.
ENTRY_BYTES = 400

_SPACE = "▁"
# White space and what follows it, up to a space that comes after something else: no token of either kind crosses such a space.
# White space at the end stays with the last stretch.
_STRETCH = r"\s*\S+(?:[^\S ]\s*\S*)*(?:\s+\Z)?|\s+"
_stretches = re.compile(_STRETCH).findall
# Stretches cut further, where the vocabularies allow it: behind a word of Latin letters and digits that a mark or a line's end
# follows, and behind marks that end a line or come before a space. So the same word is met again whatever mark follows it.
_WORD, _MARK = "A-Za-z0-9À-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~"
_parts = re.compile(rf"\s*[{_WORD}]+(?=[{_MARK}]|[ \n]\s*\S)|[{_MARK}]+(?=[ \n]\s*\S)|{_STRETCH}").findall
# A token that such a cut would go through; the bytes of one may begin inside a letter.
_crosses = re.compile(f"[{_WORD}][{_MARK}\n]|[{_MARK}]\n").search
_crosses_bytes = re.compile(rb"(?:[A-Za-z0-9]|\xc3[\x80-\xbf]|^[\x80-\xbf]+)[!-/:-@\[-`{-~\n]|[!-/:-@\[-`{-~]\n").search
# What parts without a space in front are encoded behind.
_LEAD = " a"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Two vocabularies: A byte-level by ``tokenizers``, B of pieces with byte fallback by ``sentencepiece``."""

    def __init__(self, a: bytes, b: bytes):
        self.a = Tokenizer.from_str(a.decode())
        # Text that looks like a special token is text.
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes((int(p[3:5], 16),)) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        # Stretches are independent if no piece goes on after a space that follows something else.
        self.by_stretch = not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces)
        # Names of control, unknown and byte tokens are no text.
        plain = [p for i, p in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))]
        self.by_word = self.by_stretch and not any(map(_crosses, plain)) and not any(map(_crosses_bytes, self.a_bytes))
        self.codes = suffix_pairs(self.a_bytes, self.b_bytes)
        self.names = [list(map(str, range(len(side)))) for side in (self.a_bytes, self.b_bytes)]
        # What is remembered of stretches; when the newer half is full, the older one is dropped.
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        self.used = 0

    def align_all(self, texts: list[str]) -> list[list[tuple]]:
        """For each text, the stretches of a space and the text as (tokens of A, of B, groups as text, codes of the links); none if bytes differ."""
        split = _parts if self.by_word else _stretches
        lists = [(split(" " + t) if self.by_stretch else [" " + t]) if t else [] for t in texts]
        known, older = self.known, self.older
        new = set().union(*lists).difference(known)
        again = [s for s in new if s in older]
        known.update((s, older[s]) for s in again)
        self.used += sum(map(self._size, again))
        new.difference_update(again)
        # What ends in white space would meet the next one's space, and U+2581 the space before it, so they go alone.
        alone = {s for s in new if s[-1].isspace() or _SPACE in s} if self.by_stretch else new
        row = list(chain.from_iterable(map(_behind, new - alone)))
        done = self._cut(row)
        if done is None:
            alone = new
        else:
            known.update(zip(row, done))
        known.update((s, (self._cut(_behind(s)) or [None])[-1]) for s in alone)
        out = [list(map(known.__getitem__, parts)) for parts in lists]
        for s in new:
            if len(s) > KNOWN_CHARS:
                del known[s]
            else:
                self.used += self._size(s)
        if self.used > CACHE_BYTES // 2:
            self.older, self.known, self.used = known, {}, 0
        return [[] if None in parts else parts for parts in out]

    def _size(self, stretch: str) -> int:
        done = self.known[stretch]
        return ENTRY_BYTES + len(stretch) + (len(done[2]) + len(done[3]) if done else 0)

    def _cut(self, stretches: list[str]) -> list[tuple] | None:
        """Stretches that stand in a row, encoded together and cut where tokens of both kinds end; None if the bytes differ."""
        if not stretches:
            return []
        text = "".join(stretches)
        raw = text.encode()
        a = self.a.encode(text, add_special_tokens=False)
        # B puts a space before what it is given.
        b = self.b.encode(raw[1:], return_type="offset_mapping")
        a_list, b_list = a.ids, b["ids"]
        if b"".join(map(self.a_bytes.__getitem__, a_list)) != raw or b"".join(map(self.b_bytes.__getitem__, b_list)) != raw:
            return None
        a_ids, b_ids = (np.array(ids, dtype=np.int64) for ids in (a_list, b_list))
        # Coarse cuts: ends of spans. A's spans are of characters, B's of the bytes after the space.
        spans, b_spans = (flat_pairs(offsets, len(ids)) for offsets, ids in ((a.offsets, a_ids), (b["offsets"], b_ids)))
        a_coarse = np.concatenate(([0], np.cumsum(utf8_sizes(text))))[spans[:, 1]]
        a_holds = np.append(spans[1:, 0] >= spans[:-1, 1], True)
        a_ends = refined(a_coarse, a_holds, self.a_sizes[a_ids])
        b_ends = refined(b_spans[:, 1] + 1, b_spans[:, 0] < b_spans[:, 1], self.b_sizes[b_ids])
        shared, at_a, at_b = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        ends = np.cumsum([len(s.encode()) for s in stretches])
        lasts = np.searchsorted(shared, ends)
        if not np.array_equal(shared[np.minimum(lasts, len(shared) - 1)], ends):
            return None
        codes = self.codes.find(a_ids[at_a], b_ids[at_b]).tobytes()
        a_names, b_names = list(map(self.names[0].__getitem__, a_list)), list(map(self.names[1].__getitem__, b_list))
        to_a, to_b = (at_a + 1).tolist(), (at_b + 1).tolist()
        groups = [
            f"{a_names[i]}|{b_names[j]}" if x - i == 1 == y - j else f"{','.join(a_names[i:x])}|{','.join(b_names[j:y])}"
            for i, x, j, y in zip([0, *to_a], to_a, [0, *to_b], to_b)
        ]
        out, first, la, lb = [], 0, 0, 0
        for last in (lasts + 1).tolist():
            x, y = to_a[last - 1], to_b[last - 1]
            out.append((x - la, y - lb, ";".join(groups[first:last]), codes[4 * first : 4 * last]))
            first, la, lb = last, x, y
        return out


def _behind(stretch: str) -> list[str]:
    """The stretch, with something in front that no token joins it to if it has no space there."""
    return [stretch] if stretch[0] == " " else [_LEAD, stretch]


def flat_pairs(pairs: list[tuple[int, int]], n: int) -> np.ndarray:
    return np.fromiter(chain.from_iterable(pairs), np.int64, 2 * n).reshape(-1, 2)


def utf8_sizes(text: str) -> np.ndarray:
    """Bytes of each character in UTF-8."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


def refined(coarse: np.ndarray, holds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ends of tokens. Where a span's end holds it is the token's end.

    Tokens inside a multibyte character share its span, and byte-fallback tokens but the last have empty spans. Their ends are
    counted on from the last one that holds, with the bytes that the tokens decode to. As the decoded bytes are known to be those
    of the text, an end they contradict gives way to them.
    """
    counted = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(holds, np.arange(len(sizes)), -1))
    ends = np.where(last < 0, counted, coarse[last] - counted[last] + counted)
    return ends if np.array_equal(ends, counted) else counted


class SuffixPairs:
    """All pairs of tokens that can end together, numbered. Such tokens are suffixes of each other, so there are no more than bytes in the vocabularies."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, (a << 32) | b).astype("<i4")


def suffix_pairs(a: Sequence[bytes], b: Sequence[bytes]) -> SuffixPairs:
    def by_bytes(tokens: Sequence[bytes]) -> dict[bytes, list[int]]:
        out: dict[bytes, list[int]] = {}
        for i, t in enumerate(tokens):
            out.setdefault(t, []).append(i)
        return out

    of_a, of_b = by_bytes(a), by_bytes(b)
    keys = {(i << 32) | j for i, t in enumerate(a) for k in range(len(t)) for j in of_b.get(t[k:], ())}
    keys |= {(i << 32) | j for j, t in enumerate(b) for k in range(1, len(t)) for i in of_a.get(t[k:], ())}
    return SuffixPairs(np.array(sorted(keys), dtype=np.int64))


def _row(parts: list[tuple]) -> tuple:
    """What stretches in a row come to."""
    n_a, n_b, groups, codes = zip(*parts) if parts else ((), (), (), ())
    codes = np.frombuffer(b"".join(codes), dtype="<i4")
    pairs, times = np.unique(codes, return_counts=True)
    return sum(n_a), sum(n_b), len(codes), ";".join(groups), pairs, times.astype("<i4")


@contextmanager
def _no_cycles() -> Iterator[None]:
    """Without searches for cycles: the many small tuples of spans and stretches are in none, and are freed without."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


_pairs: dict[bytes, Pair] = {}


def _pair(shared: Broadcast) -> Pair:
    """The two vocabularies of a broadcast, made ready once in a worker."""
    a, b = shared.value
    key = hashlib.md5(a + b).digest()
    if key not in _pairs:
        _pairs.clear()
        _pairs[key] = Pair(a, b)
    return _pairs[key]


class Vocabularies:
    """Files of the vocabularies A and B. The driver reads them; they have a fixed size, and workers get their content."""

    def __init__(self, spark, a: str, b: str):
        with open(a, "rb") as f, open(b, "rb") as g:
            self.content = f.read(), g.read()
        self.shared = spark.sparkContext.broadcast(self.content)


def align_tokens(docs: DataFrame, vocabularies: Vocabularies, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """All rows with the tokens of a space and the text by A and by B, cut into groups where tokens of both end.

    ``n_a``, ``n_b`` tokens; ``groups`` as ``a1,a2|b1;a3|b2,b3`` (ids in order) and ``n_groups`` of them; the links, which are the pairs
    of tokens that end together, ``n_links`` of them, as ``pairs`` (numbers of distinct pairs of ids, ascending) and ``times`` (how
    often each occurs).

    Texts are encoded whole. A space after something else ends a token in both vocabularies (that is checked for B), so the
    stretches between such spaces are encoded together where they are new to a worker, and remembered. Where no token of either holds
    a letter or digit before a mark, or one of these before a line's end (that is checked for both), words and the marks behind
    them are stretches of their own. Memory follows a text's longest such stretch and its links. Texts that are NULL, empty, or
    whose tokens don't give the text's bytes back (as with U+2581, which B takes for a space) have no tokens. ``carry`` names the input columns to keep (default: all). Columns of the input
    named like an added one are replaced.
    """
    docs = without(docs, ALIGNED)
    carried = [c for c in docs.columns if carry is None or c in carry]
    shared = vocabularies.shared
    (body,) = fresh(docs, "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(shared)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            done = 0
            while done < len(texts):
                start, size, run = done, 0, []
                while done < len(texts) and (not run or size < CHUNK):
                    run.append(texts[done].as_py())
                    size += len(run[-1])
                    done += 1
                with _no_cycles():
                    rows = [_row(parts) for parts in pair.align_all(run)]
                n_a, n_b, n, groups, pairs, times = zip(*rows)
                offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
                columns = [c.slice(start, done - start) for c in batch.columns[:-1]]
                columns += [pa.array(x, pa.int64()) for x in (n_a, n_b, n, n)] + [pa.array(groups, pa.string())]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), pa.int32())) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, *ALIGNED])

    schema = T.StructType([docs.schema[c] for c in carried])
    for name in ALIGNED[:4]:
        schema = schema.add(name, T.LongType())
    schema = schema.add("groups", T.StringType()).add("pairs", T.ArrayType(T.IntegerType())).add("times", T.ArrayType(T.IntegerType()))
    return docs.select(*[col(c) for c in carried], content(text).alias(body)).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How often each pair is linked in all rows: (pair, count). Its size is bounded by the vocabularies, whatever the rows."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    return links.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum(F.col("link.times").cast("long")).alias("count"))


def named_pairs(counts: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """Counted pairs with the ids of A and B they stand for."""
    keys = Pair(*vocabularies.content).codes.keys
    names = counts.sparkSession.createDataFrame(pd.DataFrame({"pair": np.arange(len(keys)), "a": keys >> 32, "b": keys & 0xFFFFFFFF}))
    return counts.join(F.broadcast(names), "pair").select("a", "b", "count")


def count_links(aligned: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """All rows of :func:`align_tokens` with ``n_best`` and ``count_sum`` from the counts of all rows.

    A link's count is how often its pair of ids is linked anywhere; ``count_sum`` adds them up over a row's links, ``n_best`` tells how
    many links have the highest count of their id of B. The rows are checkpointed, so texts are encoded once. There are fewer
    pairs than bytes in the two vocabularies; the driver takes their counts as one array, and workers get it by broadcast.
    Columns of the input named like an added one are replaced.
    """
    rows = kept(without(aligned, COUNTED))
    known = Pair(*vocabularies.content).codes
    found = pair_counts(rows).toArrow()
    counts = np.zeros(len(known), dtype=np.int64)
    counts[found["pair"].to_numpy()] = found["count"].to_numpy()
    of_b = known.keys & 0xFFFFFFFF
    highest = np.zeros(int(of_b.max(initial=0)) + 1, dtype=np.int64)
    np.maximum.at(highest, of_b, counts)
    shared = aligned.sparkSession.sparkContext.broadcast((counts, counts == highest[of_b]))

    @F.pandas_udf("struct<n_best:bigint,count_sum:bigint>")
    def judged(pairs: pd.Series, times: pd.Series) -> pd.DataFrame:
        counts, best = shared.value
        out = [(int(n[best[p]].sum()), int(n @ counts[p])) for p, n in ((np.asarray(p), np.asarray(n, dtype=np.int64)) for p, n in zip(pairs, times))]
        return pd.DataFrame(out, columns=["n_best", "count_sum"], dtype="int64")

    (verdict,) = fresh(rows, "verdict")
    return rows.withColumn(verdict, judged("pairs", "times")).select(*[col(c) for c in rows.columns], f"{verdict}.*")
