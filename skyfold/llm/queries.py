"""Registered queries of the pipeline operators: name -> (callable, oracle SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyfold.llm import chat, licences, mixing, negative_queries, positional, quality, secret_queries, simhash, spelling_queries, spotsigs, token_files, toxicity, warc
from skyfold.llm.common import Query, table
from skyfold.session import new_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.following_pairs(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).drop("key")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "archives")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, manifest, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", F.array_join("sentence_ids", " ").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


# Rows of its own, not those of the scan: the one-line sentences that the tables hold. The verbatim texts of whole licences
# are in the tests.
OP5_SQL = r"""
WITH known(norm, id, licence) AS (VALUES
    ('released under the mit license', 'mit-name', 'MIT'),
    ('licensed under the mit license', 'mit-licensed', 'MIT'),
    ('licensed under the apache license version 2 0', 'apache-name', 'Apache-2.0'),
    ('this work is licensed under the gnu general public license version 3', 'gpl3-name', 'GPL-3.0'),
    ('this is free and unencumbered software released into the public domain', 'unlicense', 'Unlicense'),
    ('licensed under cc by nc 4 0', 'ccbync-name', 'CC-BY-NC-4.0'),
    ('licensed under cc by 4 0', 'ccby-name', 'CC-BY-4.0'),
    ('licensed under cc by sa 4 0', 'ccbysa-name', 'CC-BY-SA-4.0'),
    ('this source code form is subject to the terms of the mozilla public license v 2 0', 'mpl-subject', 'MPL-2.0')
), rules(no, licence) AS (VALUES
    (1, 'MIT'), (2, 'Apache-2.0'), (3, 'GPL-3.0'), (4, 'Unlicense'), (5, 'CC-BY-NC-4.0'), (6, 'CC-BY-4.0'), (7, 'CC-BY-SA-4.0'), (8, 'MPL-2.0')
), cut AS (
    SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '[.!?][ \t\r\n]+|[;:]|\n') AS parts FROM documents
), sentences AS (
    SELECT doc_id, i, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS norm
    FROM (SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS i FROM cut)
), lines AS (
    SELECT doc_id, i, id, licence FROM sentences JOIN known USING (norm)
), named AS (
    SELECT doc_id, string_agg(licence, ',' ORDER BY no) AS licences FROM (SELECT DISTINCT doc_id, licence FROM lines) JOIN rules USING (licence) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_sentences, string_agg(id, ' ' ORDER BY i) AS ids FROM lines GROUP BY doc_id
)
SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(licences, '') AS licences
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


OP6_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), w AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(list_slice(words, i + 1, i + 10), ' ') AS phrase
    FROM (SELECT item_id, words, unnest(range(0, greatest(len(words) - 10, 0) + 1)) AS i FROM b WHERE len(words) > 0)
), grams AS (
    SELECT doc_id, n, i, array_to_string(list_slice(words, i + 1, i + n), ' ') AS phrase
    FROM (SELECT doc_id, n, words, unnest(range(0, len(words) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM w) WHERE len(words) >= n)
), hits AS (
    SELECT DISTINCT doc_id, item_id, n, i FROM grams JOIN w USING (n, phrase)
), places AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(table(spark, sf_dir, "conversations"))


OP7_SQL = """
WITH t AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), p AS (
    SELECT *, row_number() OVER w AS pos, string_agg(role || chr(30) || text || chr(31), '') OVER w AS prefix,
           string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '') OVER w AS rendered
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
), n AS (
    SELECT conv_id, max(pos) AS n FROM p GROUP BY conv_id
), whole AS (
    SELECT prefix, rendered, n, min(conv_id) AS conv_id, count(*) AS copies FROM p JOIN n USING (conv_id) WHERE pos = n GROUP BY prefix, rendered, n
)
SELECT conv_id, n AS n_turns, copies, rendered FROM whole
WHERE prefix NOT IN (SELECT prefix FROM p JOIN n USING (conv_id) WHERE pos < n)
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-ids")
    manifest = token_files.write_ids(table(spark, sf_dir, "documents"), folder, TOKENIZER)
    return token_files.read_ids(spark, folder, manifest)


REGISTERED: dict[str, Query] = {
    "op1_spotsigs": (op1_spotsigs, None),
    "op2_mixing": (op2_mixing, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_warc": (op4_warc, OP4_SQL),
    "op5_licences": (op5_licences, OP5_SQL),
    "op6_decontaminate": (op6_decontaminate, OP6_SQL),
    "op7_chat": (op7_chat, OP7_SQL),
    "op8_quality": (op8_quality, None),
    "op9_simhash": (op9_simhash, None),
    "op10_token_ids": (op10_token_ids, None),
} | spelling_queries.REGISTERED | negative_queries.REGISTERED | secret_queries.REGISTERED
