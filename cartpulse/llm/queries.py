"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartpulse.llm import (bpe, decontaminate, html_text, lang_id, nn_descent, packing,
                           periodic_runs, pivots, prefix_trie, simhash, token_counts, toxicity, warc)
from cartpulse.llm.frames import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.roundtrip_digests(table(spark, sf_dir, "documents"), BYTE_BPE)


def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_roundtrip(table(spark, sf_dir, "pages"))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), lambda key: key % 50 == 0)


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.languages(table(spark, sf_dir, "documents"))


def op7_pivot_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_budget(table(spark, sf_dir, "documents"), WORD_BPE)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))


QUERIES = {q.__name__: q for q in (
    op1_toxicity, op2_bpe_roundtrip, op3_warc_salvage, op4_nn_descent, op5_page_text,
    op6_language_id, op7_pivot_duplicates, op8_simhash, op9_packing, op10_token_counts,
    op11_periodic_runs, op12_prefix_trie, op13_decontamination)}

# The others need models, tokenizers, a text hash or an alignment that SQL lacks.
ORACLES = {
    "op3_warc_salvage": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        groups AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest
            FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> largest
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> largest
                    THEN largest END AS refers_to
        FROM groups""",
    # all pairs; the index finds the same links on the given tables
    "op7_pivot_duplicates": """
        WITH RECURSIVE valid AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE label IS NOT NULL
              AND isfinite(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))
              AND list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM valid a
            JOIN valid b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
        reached(vec_id, other) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other)
        SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
               min(other) AS component_id, min(other) = vec_id AS kept
        FROM reached GROUP BY vec_id""",
    # crc32 bit by bit: -1 after each byte of the id stands for one bit
    "op12_prefix_trie": """
        WITH placed AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
                          || coalesce(text, ''))[:32] AS id, turn
            FROM conversations WHERE conv_id IS NOT NULL),
        numbered AS (
            SELECT *, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS i
            FROM placed),
        convs AS (
            SELECT conv_id, conv_id - conv_id % 5 AS base,
                   xor(list_reduce(
                       list_prepend(4294967295::BIGINT, flatten([
                           [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
                           FOR c IN string_split(conv_id::VARCHAR, '')])),
                       lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                                    ELSE xor(a >> 1, (a & 1) * 3988292384) END),
                       4294967295::BIGINT) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM numbered)),
        rebuilt AS (
            SELECT c.conv_id, 0 AS part, n.i, n.id, n.text
            FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.i < c.h
            UNION ALL
            SELECT c.conv_id, 1, n.i, n.id, n.text
            FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.i >= c.h),
        lists AS (
            SELECT c.conv_id, coalesce(list(id ORDER BY part, i) FILTER (id IS NOT NULL), [])
                       AS ids,
                   coalesce(list(strlen(text) ORDER BY part, i) FILTER (id IS NOT NULL), [])
                       AS sizes
            FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
        paths AS (
            SELECT conv_id, d, len(ids) = d AS ended, array_to_string(ids[1:d], ' ') AS node,
                   CASE WHEN d > 0 THEN array_to_string(ids[1:d - 1], ' ') END AS parent,
                   coalesce(sizes[d], 0) AS bytes
            FROM lists, unnest(range(0, len(ids) + 1)) AS t(d)),
        nodes AS (
            SELECT node, d, parent, min(conv_id) AS conv_id, count(*) AS n_convs,
                   max(bytes) AS bytes, count(*) FILTER (ended) AS n_ends,
                   string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended) AS ends
            FROM paths GROUP BY node, d, parent),
        subtrees AS (
            SELECT p.node, p.d, count(*) FILTER (n.n_convs = n.n_ends) AS n_leaves,
                   sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
            FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.d <= n.d
            GROUP BY p.node, p.d),
        children AS (SELECT parent, d, count(*) AS n_children FROM nodes GROUP BY parent, d)
        SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs,
               coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
               sha256(coalesce(n.ends, '')) AS ends_sha256
        FROM nodes n JOIN subtrees s ON s.node = n.node AND s.d = n.d
        LEFT JOIN nodes u ON u.node = n.parent AND u.d = n.d - 1
        LEFT JOIN children c ON c.parent = n.node AND c.d = n.d + 1""",
    "op13_decontamination": r"""
        WITH letters AS (
            SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper_case,
                   'abcdefghijklmnopqrstuvwxyz' AS lower_case,
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word),
        docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), upper_case, lower_case), word) AS w
            FROM documents, letters),
        items AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), upper_case, lower_case), word) AS w
            FROM benchmark, letters),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS m,
                   array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
            FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i)
            WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT m FROM windows),
        grams AS (
            SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS gram
            FROM docs, sizes, unnest(range(1, len(w) - m + 2)) AS t(i)),
        found AS (SELECT r, i, m, item_id FROM grams JOIN windows USING (m, gram)),
        words AS (
            SELECT r, count(DISTINCT i + k) AS n_hit
            FROM found, unnest(range(0, m)) AS t(k) GROUP BY r),
        listed AS (
            SELECT r, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM found GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN words USING (r) LEFT JOIN listed USING (r)""",
}
