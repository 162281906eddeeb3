"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmill.llm.bpe import bpe_digest
from starmill.llm.decontaminate import contamination_digest
from starmill.llm.fingerprints import fingerprint_neighbours
from starmill.llm.hard_negatives import hard_negatives
from starmill.llm.jaccard_join import near_duplicates
from starmill.llm.line_dedup import dedup_digest
from starmill.llm.lm_scoring import language_scores
from starmill.llm.mixing import KEEP, MARGINS, POWERS, SALT, SWEEPS, TOPIC_BYTES, TOPICS, mixture
from starmill.llm.personal_data import personal_data
from starmill.llm.prefix_trie import GROUP, SHARED, trie_digest
from starmill.llm.prefix_trie import GROUP, SHARED, trie_digest
from starmill.llm.token_counts import token_counts
from starmill.llm.toxicity import toxicity
from starmill.llm.warc import archive_roundtrip

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_neighbours(_table(spark, folder, "documents"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination_digest(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(_table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts(_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return language_scores(_table(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_roundtrip(_table(spark, folder, "pages"))


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), words_per_shingle=3, percent=90)


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixture(_table(spark, folder, "documents"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_digest(_table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie_digest(_table(spark, folder, "conversations"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(_table(spark, folder, "embeddings"))


def op13_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe_digest(_table(spark, folder, "documents"), public_tokenizers.path(WORD_TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_fingerprints, op2_decontamination, op3_toxicity, op4_personal_data, op5_token_counts, op6_lm_scoring, op7_warc, op8_jaccard_join, op9_mixing,
        op10_line_dedup, op11_prefix_trie, op12_hard_negatives,
        op13_bpe)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


_ALPHANUMERIC = r"[0-9a-z\x{80}-\x{10FFFF}]+"

_OP2 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_lowered("text")}, '{_ALPHANUMERIC}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_lowered("text")}, '{_ALPHANUMERIC}') AS w FROM benchmark),
wins AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size,
           array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
),
places AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM d, (SELECT DISTINCT size FROM wins) WHERE len(w) >= size)
),
hits AS (SELECT doc_id, i, size, item_id FROM places JOIN wins USING (size, win)),
words AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS at FROM hits),
n AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# 160 bits as 32 groups of five: five hexadecimal digits are four groups.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"CAST(((CAST('0x' || substr(hash, {1 + 5 * i}, 5) AS INTEGER) >> {15 - 5 * k}) & 31) + 1 AS INTEGER), 1)"
    for i in range(8) for k in range(4))

_OP7 = f"""
WITH p AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hash
    FROM pages
),
f AS (SELECT hash, min(page_id) AS first FROM p GROUP BY hash)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p JOIN f USING (hash)
"""

_WORD = r"[^\x20\x09-\x0D]+"

_OP8 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({_lowered("text")}, '{_WORD}') AS w FROM documents
),
sets AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY x, y
),
links AS (
    SELECT x, y FROM shared o JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * o.n >= 90 * (a.n + b.n - o.n)
),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION SELECT r.x, e.y FROM reached r JOIN edges e ON r.y = e.x
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(y) AS component_id
FROM reached JOIN documents ON doc_id = x LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP10 = f"""
WITH lines AS (
    SELECT doc_id, i, line, {_lowered(f"trim(line, {_SPACES})")} AS key
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
          FROM documents)
),
common AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
    SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
    FROM lines LEFT JOIN common USING (key)
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WEIGHTS = ",\n".join(f"""
t_{m} AS (SELECT {m}, p / sum(p) OVER () AS t
          FROM (SELECT {m}, pow(CAST(sum(tokens) AS DOUBLE), {POWERS[m]}) AS p FROM cells GROUP BY {m}))"""
                       for m in MARGINS)
_RAKED = ",\n".join(f"""
w{k + 1} AS (SELECT w{k}.* EXCLUDE (w), w * t / sum(w) OVER (PARTITION BY {m}) AS w FROM w{k} JOIN t_{m} USING ({m}))"""
                    for k, m in enumerate(MARGINS * SWEEPS))

_OP9 = f"""
WITH d AS (
    SELECT doc_id, source AS src, lang AS lng, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
           regexp_extract_all({_lowered("text")}, '{_WORD}') AS w
    FROM documents
),
counted AS (
    SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d)
    WHERE strlen(word) >= {TOPIC_BYTES} GROUP BY doc_id, word
),
best AS (
    SELECT doc_id, CAST(CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % {TOPICS} AS INTEGER) AS topic
    FROM counted QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) = 1
),
rows AS (
    SELECT doc_id, src, lng, source, lang, coalesce(topic, -1) AS topic, CAST(len(w) + 1 AS BIGINT) AS tokens
    FROM d LEFT JOIN best USING (doc_id)
),
cells AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM rows GROUP BY ALL),
{_WEIGHTS},
w0 AS (SELECT source, lang, topic, tokens, sum(tokens) OVER () AS total, tokens / sum(tokens) OVER () AS w FROM cells),
{_RAKED},
factors AS (SELECT source, lang, topic, tokens, total, w * total / tokens AS factor FROM w{len(MARGINS) * SWEEPS}),
-- Cells by factor: the first ones are whole, up to the first for which the rest suffices.
ranked AS (
    SELECT *, row_number() OVER o AS i, sum(tokens) OVER o - tokens AS before,
           sum(tokens * factor) OVER (ORDER BY factor, source DESC, lang DESC, topic DESC) AS rest
    FROM factors WINDOW o AS (ORDER BY factor DESC, source, lang, topic)
),
scale AS (
    SELECT arg_min(({KEEP} * total - before) / rest, i) AS s FROM ranked WHERE factor * ({KEEP} * total - before) / rest <= 1
),
p AS (SELECT *, least(factor * s, 1) AS probability, greatest(factor * s, 1) AS weight FROM factors, scale)
SELECT doc_id, src AS source, lng AS lang, topic, tokens_of AS n_tokens, round(factor, 6) AS factor,
       round(probability, 6) AS probability, round(weight, 6) AS weight,
       CAST('0x' || substr(md5('{SALT}:' || doc_id), 1, 12) AS BIGINT) / CAST({16 ** 12} AS DOUBLE) < probability AS kept
FROM (SELECT * EXCLUDE (tokens), tokens AS tokens_of FROM rows) JOIN p USING (source, lang, topic)
"""

# CRC-32, bit by bit, of the letters of a number.
_CRC32 = """xor(4294967295, list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda t: CAST(ascii(t) AS BIGINT)),
    lambda crc, byte: list_reduce(
        CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[]), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)), xor(crc, byte)),
    CAST(4294967295 AS BIGINT)))"""

_OP11 = f"""
WITH t AS (
    SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t
    FROM conversations WHERE conv_id IS NOT NULL
),
kinds AS (SELECT r, t, length(t) AS chars, row_number() OVER () AS k FROM (SELECT DISTINCT r, t FROM t)),
seqs AS (
    SELECT conv_id, list(k ORDER BY turn NULLS FIRST, md5(concat(strlen(r), ':', r, t))) AS w
    FROM t JOIN kinds USING (r, t) GROUP BY conv_id
),
heads AS (SELECT *, {_CRC32} % {SHARED} AS h FROM seqs),
rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(b.w, [])[1:a.h], a.w[a.h + 1:]) AS w
    FROM heads a LEFT JOIN seqs b ON b.conv_id = a.conv_id - a.conv_id % {GROUP}
),
members AS (
    SELECT conv_id, d, d = len(w) AS at_end, w[1:d] AS p FROM (SELECT *, unnest(range(0, len(w) + 1)) AS d FROM rebuilt)
),
nodes AS (
    SELECT p, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs,
           string_agg(CASE WHEN at_end THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
    FROM members GROUP BY p
),
children AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (
    SELECT p, depth, (n_convs - 1) * coalesce(chars, 0) AS saved, n_children IS NULL AS leaf
    FROM nodes LEFT JOIN kinds ON k = p[depth] LEFT JOIN children USING (p)
),
below AS (
    SELECT p[1:d] AS p, sum(saved) AS saved_tokens, count_if(leaf) AS n_leaves
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM valued) GROUP BY 1
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN below USING (p) LEFT JOIN children USING (p)
LEFT JOIN nodes u ON n.depth > 0 AND u.p = n.p[1:n.depth - 1]
"""

_OP12 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
    SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
           list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * x.q[i])) AS score
    FROM v a JOIN v x ON a.vec_id % 100 = 0 AND x.vec_id <> a.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, CAST(positive_score AS BIGINT) AS positive_score, CAST(score AS BIGINT) AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

SQL: dict[str, str] = {"op2_decontamination": _OP2, "op7_warc": _OP7, "op8_jaccard_join": _OP8,
    "op9_mixing": _OP9, "op10_line_dedup": _OP10, "op11_prefix_trie": _OP11, "op12_hard_negatives": _OP12}
