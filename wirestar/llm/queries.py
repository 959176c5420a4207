"""The registered queries: each operator over its whole table, at production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirestar.llm import (
    exact_dedup,
    hard_negatives,
    language_id,
    minhash,
    packing,
    secrets,
    sharding,
    syncmers,
    token_alignment,
    token_files,
    toxicity,
    transcripts,
    word_bpe,
)
from wirestar.llm.common import documents
from wirestar.sources.staging import Staging


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_duplicates(documents(spark, sf_dir), Staging(spark))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_documents(documents(spark, sf_dir), labels, Staging(spark))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_with_next(documents(spark, sf_dir), Staging(spark))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir), Staging(spark))


def op5_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.digest_documents(documents(spark, sf_dir), WORD_BPE)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, sf_dir), Staging(spark)))


def op7_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return transcripts.format_conversations(conversations, Staging(spark))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    path = staging.path("tokens")
    token_files.write_tokens(documents(spark, sf_dir), path, BYTE_BPE, staging)
    read = token_files.read_tokens(spark, path)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return read.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), Staging(spark))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), BYTE_BPE, Staging(spark))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.balanced_tree()
    grown = sharding.with_new_shard(tree)
    return sharding.shard_documents(documents(spark, sf_dir), tree, grown, Staging(spark))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Staging(spark))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(
        documents(spark, sf_dir), BYTE_BPE, PIECE_BPE, Staging(spark)
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_fingerprints": op3_fingerprints,
    "op4_language_id": op4_language_id,
    "op5_word_bpe": op5_word_bpe,
    "op6_secrets": op6_secrets,
    "op7_transcripts": op7_transcripts,
    "op8_token_files": op8_token_files,
    "op9_minhash": op9_minhash,
    "op10_packing": op10_packing,
    "op11_sharding": op11_sharding,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256,
               CAST(1 AS INTEGER) AS chain_length
        FROM t WINDOW same AS (PARTITION BY norm)
    """,
    "op12_hard_negatives": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
            FROM embeddings
            WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
                   CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
            FROM v a JOIN v r ON a.vec_id <> r.vec_id
            WHERE a.vec_id % 50 = 0
        ), p AS (
            SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5
        )
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
                                       ORDER BY score DESC, row_id) AS INTEGER) AS rank,
               row_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3
    """,
}
