"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tessera.llm import (
    bpe_automaton,
    conv_toxicity,
    crf_language,
    curriculum_mix,
    factor_quality,
    group_packing,
    histogram_shards,
    kn_quality,
    partition_join,
    spelling_variants,
    token_alignment,
    vamana_index,
    warc_bundles,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_neighbours(spark, sf_dir):
    return vamana_index.search_embeddings(_table(spark, sf_dir, "embeddings"))


def op2_language(spark, sf_dir):
    return crf_language.identify_documents(_table(spark, sf_dir, "documents"))


def op3_warc(spark, sf_dir):
    rows = warc_bundles.archive_pages(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_mix(spark, sf_dir):
    return curriculum_mix.mix_documents(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark, sf_dir):
    return kn_quality.judge_documents(_table(spark, sf_dir, "documents"))


def op6_packing(spark, sf_dir):
    return group_packing.pack_documents(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    return conv_toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_shards(spark, sf_dir):
    return histogram_shards.shard_documents(_table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    return factor_quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_ngram_join(spark, sf_dir):
    return partition_join.link_documents(_table(spark, sf_dir, "documents"))


def op11_tokens(spark, sf_dir):
    return bpe_automaton.digest_documents(_table(spark, sf_dir, "documents"))


def op12_spelling(spark, sf_dir):
    return spelling_variants.variants(_table(spark, sf_dir, "documents"))


def op13_alignment(spark, sf_dir):
    return token_alignment.align_documents(_table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_language": op2_language,
    "op3_warc": op3_warc,
    "op4_mix": op4_mix,
    "op5_quality_rules": op5_quality_rules,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_shards": op8_shards,
    "op9_quality": op9_quality,
    "op10_ngram_join": op10_ngram_join,
    "op11_tokens": op11_tokens,
    "op12_spelling": op12_spelling,
    "op13_alignment": op13_alignment,
    "pipeline": corpus_pipeline.run,
}

LLM_SQL = {
    "op3_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
        ), g AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload) AS top FROM p
        )
        SELECT page_id,
               CAST(strlen(payload) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER)
                       >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
        FROM g
    """,
    # crc32 by the table of its polynomial 0xEDB88320; U+00C0 to U+00FF are the bytes 195 and the code point less 64
    "op12_spelling": """
        WITH RECURSIVE crc_table AS (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                FROM range(256) r(i))
        ), runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                   unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run FROM documents
        ), words AS (
            SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
            FROM runs WHERE length(run) >= 6 GROUP BY 1, 2
        ), hashed AS (
            SELECT w, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || w, ''), lambda c:
                    CASE WHEN unicode(c) >= 192 THEN [195::BIGINT, unicode(c)::BIGINT - 64] ELSE [unicode(c)::BIGINT] END))),
                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
            FROM words, crc_table
        ), cut AS (
            SELECT n, CASE WHEN h % 199 = 0 THEN left(w, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word
            FROM hashed
        ), v AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ), gaps AS (
            SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
        ), near AS (
            SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, a.n, b.word, b.n FROM gaps a JOIN v b ON a.rest = b.word
            UNION SELECT b.word, b.n, a.word, a.n FROM gaps a JOIN v b ON a.rest = b.word
        ), top AS (
            SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word, n
        ), links AS (SELECT word, form, form_n FROM top WHERE form_n >= 5 * n),
        chain AS (
            SELECT word, form AS root, 1 AS step FROM links
            UNION ALL SELECT c.word, l.form, step + 1 FROM chain c JOIN links l ON l.word = c.root
        ), roots AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
        SELECT v.word, l.form, coalesce(r.root, v.word) AS root, v.n, CAST(coalesce(t.n_near, 0) AS BIGINT) AS n_near, CAST(l.form_n AS BIGINT) AS form_n
        FROM v LEFT JOIN top t ON t.word = v.word LEFT JOIN links l ON l.word = v.word LEFT JOIN roots r ON r.word = v.word
    """,
}
