"""The registered queries of this subpackage and the SQL each is checked against, where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import (
    byte_bpe,
    conversations,
    decontamination,
    language_id,
    language_model,
    manifest,
    pii,
    quality,
    simhash_dedup,
    substring_dedup,
    token_counts,
    toxicity,
    url_filters,
)
from tradewind.llm.text import documents

TOKENIZERS = "/opt/tokenizers"


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is; the folder is a parameter of this machine."""
    try:
        import public_tokenizers
    except ImportError:
        return f"{TOKENIZERS}/{name}"
    return public_tokenizers.path(name)


# Most of these queries end in a model, a hash or a tokenizer that SQL does not have; their tests hold them against brute force.
SQL: dict[str, str] = {
    "op3_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), windows AS (
            SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS window_hash
            FROM split, unnest(range(1, len(words) - 48)) AS place(i) WHERE len(words) >= 50
        ), first_seen AS (
            SELECT window_hash, min(doc_id) AS first_doc FROM windows GROUP BY window_hash
        ), gone AS (
            SELECT DISTINCT doc_id, i + k AS i
            FROM windows JOIN first_seen USING (window_hash), unnest(range(0, 50)) AS step(k) WHERE first_doc < doc_id
        ), kept AS (
            SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text
            FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split) w
            ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id
        ), removed AS (
            SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM split LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op11_merkle_manifest": r"""
        WITH RECURSIVE marked AS (
            SELECT *, coalesce('s' || source, '') AS tree, xor(4294967295::UBIGINT, list_reduce(
                list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
                lambda crc, byte: list_reduce(
                    [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384::UBIGINT * (c & 1)))
            )) % 5 = 0 AS changes FROM documents
        ), rows AS (
            SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                sha256(head || coalesce(strlen(claim) || ':' || claim, '-')) AS claimed
            FROM (SELECT *, concat(
                    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
                CASE WHEN changes THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claim
                FROM marked)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM rows
        ), nodes AS (
            SELECT 0 AS level, tree, pos, n, leaf AS digest FROM placed
            UNION ALL
            SELECT level + 1, tree, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
            FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 16, n
        ), upper_nodes AS (
            SELECT 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, digest, tree FROM nodes WHERE n = 1
            UNION ALL
            SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)), ''
            FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 16, n
        ), sides AS (
            SELECT level, tree, pos,
                coalesce(string_agg(digest, '') OVER (PARTITION BY level, tree, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS left_side,
                coalesce(string_agg(digest, '') OVER (PARTITION BY level, tree, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS right_side
            FROM nodes WHERE n > 1
        ), upper_sides AS (
            SELECT level, pos,
                coalesce(string_agg(digest, '') OVER (PARTITION BY level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS left_side,
                coalesce(string_agg(digest, '') OVER (PARTITION BY level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS right_side
            FROM upper_nodes WHERE n > 1
        ), climb AS (
            SELECT doc_id, tree, pos AS place, leaf, claimed AS folded, '' AS proof, 0 AS level, pos FROM placed
            UNION ALL
            SELECT doc_id, c.tree, place, leaf, sha256(left_side || folded || right_side), proof || left_side || right_side, c.level + 1, c.pos // 16
            FROM climb c JOIN sides s ON c.tree = s.tree AND c.level = s.level AND c.pos = s.pos
        ), tops AS (
            SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY tree, place ORDER BY level DESC) = 1
        ), upper_climb AS (
            SELECT doc_id, t.tree, place, leaf, folded, proof, u.digest AS subroot, 0 AS level, u.pos
            FROM tops t JOIN upper_nodes u ON u.level = 0 AND u.tree = t.tree
            UNION ALL
            SELECT doc_id, c.tree, place, leaf, sha256(left_side || folded || right_side), proof || left_side || right_side, subroot, c.level + 1, c.pos // 16
            FROM upper_climb c JOIN upper_sides s ON c.level = s.level AND c.pos = s.pos
        ), ends AS (
            SELECT * FROM upper_climb QUALIFY row_number() OVER (PARTITION BY tree, place ORDER BY level DESC) = 1
        )
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM ends JOIN (SELECT digest AS root FROM upper_nodes WHERE n = 1) r ON true
    """,
}


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(documents(spark, sf_dir), benchmark).drop("text_key")


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(documents(spark, sf_dir))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.decisions(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(documents(spark, sf_dir)).drop("text_key")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        return token_counts.per_document(documents(spark, sf_dir), file.read())


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(documents(spark, sf_dir))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.grouped(documents(spark, sf_dir))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proven(documents(spark, sf_dir))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audited(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_language_model,
        op3_substring_dedup,
        op4_quality_rules,
        op5_personal_data,
        op6_token_counts,
        op7_language_id,
        op8_byte_bpe,
        op9_simhash_near_dedup,
        op10_url_filters,
        op11_merkle_manifest,
        op12_toxicity,
        op13_conversation_repair,
    )
}
