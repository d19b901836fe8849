"""The text operators as queries over whole tables, with equivalent SQL where SQL can say it."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from strata.llm.alignment import Vocabularies, align_tokens, count_links
from strata.llm.bpe import Bpe, bpe_encode
from strata.llm.common import content
from strata.llm.compression import fit_quality, quality_scores
from strata.llm.exact import exact_dedup
from strata.llm.lines import line_dedup
from strata.llm.minhash import near_dedup
from strata.llm.mixing import mix
from strata.llm.packing import pack_pieces, token_pieces
from strata.llm.pii import pii_spans
from strata.llm.rules import STOP_WORDS, quality_rules
from strata.llm.sharding import kd_shards, payload
from strata.llm.toxicity import fit_toxicity, toxicity_scores
from strata.llm.trie import prefix_trie, turn_paths
from strata.queries.base import Query, table

QUERIES: dict[str, Query] = {"pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


_WS = r"[^\x20\x09-\x0D]+"


@query(
    "op1_minhash",
    rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{_WS}') AS ws
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM words WHERE len(ws) > 0)
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), common AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS (
        SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
    ), reach AS (
        SELECT doc_id, doc_id AS node FROM documents
        UNION
        SELECT reach.doc_id, y FROM reach JOIN links ON node = x
    )
    SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(node) AS component_id, doc_id = min(node) AS kept
    FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
)
def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_dedup(docs, shingle=4).drop("text")


@query("op2_shards")
def op2_shards(spark: SparkSession, folder: str) -> DataFrame:
    """40 shards of nearly equal bytes by language, source, length and id."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    # What the result has of a text is taken before rows move, so that no text does.
    docs = docs.withColumns({"size": payload("text"), "text_crc32": F.crc32(content("text").cast("binary"))})
    return kd_shards(docs, ["lang", "source", "n_chars", "doc_id"], leaves=40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op3_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return exact_dedup(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.sha2(content("text").cast("binary"), 256).alias("text_sha256")
    )


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


@query(
    "op5_quality_rules",
    rf"""
    WITH base AS (
        SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{_WS}') AS ws
        FROM documents
    ), counts AS (
        SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
               (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{_WS}')) AS lines,
               len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop
        FROM base
    ), windows AS (
        SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM base WHERE len(ws) > 2)
    ), twice AS (
        SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
    ), covered AS (
        SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
    ), measured AS (
        SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(n, 0)::BIGINT AS n_repeat_words, n_stop, len(lines) AS n_lines
        FROM counts LEFT JOIN covered USING (doc_id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AND n_symbols / n_words <= 0.2
           AND n_stop / n_words >= 0.02 AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5) AS kept
    FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
    """,
)
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query(
    "op9_mix",
    rf"""
    WITH RECURSIVE rows AS (
        SELECT doc_id, source, coalesce(text, '') AS body, len(regexp_extract_all(coalesce(text, ''), '{_WS}'))::BIGINT AS size,
               -ln((('0x' || left(md5('mix|' || doc_id), 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE)
               / greatest(0.05::DOUBLE, 1.0::DOUBLE - 4.0::DOUBLE * (strlen(body) - strlen(regexp_replace(body, '[#*$%&|<>!]', '', 'g')))
                          / greatest(strlen(body), 1)) AS key
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w
        FROM rows GROUP BY source
    ), rounds AS (
        SELECT 0 AS step, source, source_size, w, false AS full_, 0.0::DOUBLE AS level FROM sources
        UNION ALL
        SELECT step + 1, source, source_size, w, full_ OR new_level * w >= 2.0::DOUBLE * source_size, new_level
        FROM (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - sum(CASE WHEN full_ THEN 2.0::DOUBLE * source_size ELSE 0 END) OVER ())
                        / nullif(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER (), 0) AS new_level FROM rounds)
        WHERE step < (SELECT count(*) + 1 FROM sources)
    ), targets AS (
        SELECT source, source_size, CASE WHEN full_ THEN 2.0::DOUBLE * source_size ELSE level * w END AS target
        FROM rounds WHERE step = (SELECT max(step) FROM rounds)
    ), placed AS (
        SELECT doc_id, r.source, size, source_size, target, floor(target / nullif(source_size, 0)) AS epochs,
               coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, round(target, 3) AS target,
           coalesce(epochs * size + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size THEN size ELSE 0 END, 0)::BIGINT AS taken
    FROM placed
    """,
)
def op9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Targets are rounded to a thousandth of a word, so that the order of additions doesn't show."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query("op4_compression_quality")
def op4_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    model = fit_quality(docs, labels, _remainder(5) != 0)
    return quality_scores(docs, model).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op6_pii")
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii_spans(table(spark, folder, "documents").select("doc_id", "text"))

    def base(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[base(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(listed(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


_DROP = "left({0}, i::INT) || substr({0}, i::INT + 2)"


@query(
    "op7_line_dedup",
    rf"""
    WITH lines AS (
        SELECT doc_id, doc_id * 1000000000 + pos AS place, all_lines[pos] AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines, unnest(range(1, len(all_lines) + 1)) AS pos FROM documents)
    ), firsts AS (
        SELECT line, min(place) AS place FROM lines WHERE length(line) >= 16 AND regexp_matches(line, '{_WS}') GROUP BY line
    ), pairs AS (
        SELECT a.line AS x, b.line AS y FROM firsts a JOIN firsts b
        ON left(a.line, 7) = left(b.line, 7) AND b.place < a.place AND abs(length(a.line) - length(b.line)) <= 1
        UNION
        SELECT a.line, b.line FROM firsts a JOIN firsts b
        ON right(a.line, 7) = right(b.line, 7) AND b.place < a.place AND abs(length(a.line) - length(b.line)) <= 1
    ), near AS (
        SELECT DISTINCT x AS line FROM pairs
        WHERE CASE WHEN length(x) = length(y) THEN len(list_filter(range(length(x)), lambda i: {_DROP.format('x')} = {_DROP.format('y')}))
                   WHEN length(x) > length(y) THEN len(list_filter(range(length(x)), lambda i: {_DROP.format('x')} = y))
                   ELSE len(list_filter(range(length(y)), lambda i: {_DROP.format('y')} = x)) END > 0
    ), judged AS (
        SELECT l.*, f.line IS NOT NULL AND (l.place > f.place OR n.line IS NOT NULL) AS gone
        FROM lines l LEFT JOIN firsts f ON l.line = f.line LEFT JOIN near n ON l.line = n.line
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
    FROM judged GROUP BY doc_id
    """,
)
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", "text")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    model = fit_toxicity(docs, labels, _remainder(4) != 2)
    return toxicity_scores(docs, model).select(
        "doc_id", (_remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op10_bpe")
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    bpe = Bpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = bpe_encode(table(spark, folder, "documents").select("doc_id", "text"), bpe, carry=["doc_id"], decoded=True)
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


# CRC-32 of a decimal, bit by bit.
_CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                          lambda crc, x: list_reduce([xor(crc, x)] || list_transform(range(8), lambda i: 0::BIGINT),
                                                     lambda y, z: xor(y >> 1, 3988292384::BIGINT * (y & 1)))))"""


@query(
    "op11_trie",
    f"""
    WITH originals AS (
        SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, md5(text)) AS ts
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ), rebuilt AS (
        SELECT o.c, coalesce(b.ts[1:h], []) || o.ts[h + 1:] AS ts
        FROM (SELECT *, {_CRC.format("c")} % 6 AS h FROM originals) o LEFT JOIN originals b ON b.c = o.c - o.c % 100
    ), members AS (
        SELECT c, len(ts) AS n, d, ts[1:d] AS node FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)
    ), nodes AS (
        SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ends,
               CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(node[d].t) END AS saved
        FROM members GROUP BY node, d
    ), children AS (
        SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
    ), counted AS (
        SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)
    ), subtrees AS (
        SELECT node[1:k] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
        FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM counted) GROUP BY ALL
    )
    SELECT a.conv_id, a.d AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(a.ends) AS ends_sha256
    FROM counted a JOIN subtrees s ON s.node = a.node LEFT JOIN nodes p ON a.d > 0 AND p.node = a.node[1:a.d - 1]
    """,
)
def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(turn_paths(table(spark, folder, "conversations"), head=6, every=100))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    both = Vocabularies(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    aligned = align_tokens(table(spark, folder, "documents").select("doc_id", "text"), both, carry=["doc_id"])
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times")
    return count_links(rows, both).drop("pairs", "times")


@query("op13_packing")
def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"])
    # Only the digest of the ids moves on.
    return pack_pieces(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
