"""The registered queries: contract columns, one row per document, and SQL where there is any."""

import pytest

import __spark_entry__ as contract
from tests.oracle_check import connect, oracle_rows, spark_rows
from wirestar.llm.queries import ORACLE, QUERIES
from wirestar.sources.staging import owned_staging

COLUMNS = {
    "op1_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                         "near_edited", "near_next"],
    "op4_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op5_word_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7_transcripts": ["conv_id", "chunk", "turn", "role", "continues", "n_lines", "chat"],
    "op8_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op9_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op10_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op11_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op12_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                            "negative_score"],
    "op13_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                             "groups_sha256"],
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, sf_dir, name):
    with owned_staging(spark):
        columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
        df_columns = QUERIES[name](spark, sf_dir).columns if name == "op1_exact_dedup" else None
    assert set(COLUMNS[name]) <= set(columns)
    if df_columns:
        assert df_columns[: len(COLUMNS[name])] == COLUMNS[name]
    if name not in ("op7_transcripts", "op10_packing", "op12_hard_negatives"):
        at = columns.index("doc_id")
        assert len({r[at] for r in rows}) == len(rows) == 200
    if name in ORACLE:
        assert (columns, rows) == oracle_rows(connect(sf_dir), ORACLE[name])
