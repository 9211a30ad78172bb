"""Registered queries of the pipeline operators, and their DuckDB equivalents."""

from __future__ import annotations

from plumbline.llm import conversation_repair, decontamination, embedding_dedup, language_id, line_dedup, merkle, ngram_join, packing, pii, secret_scan, token_binary, toxicity, window_dedup


def queries() -> dict:
    found = (
        token_binary.op1_token_binary,
        secret_scan.op2_secret_scan,
        language_id.op3_language_id,
        line_dedup.op4_line_dedup,
        packing.op5_best_fit_packing,
        toxicity.op6_toxicity,
        ngram_join.op7_ngram_jaccard,
        embedding_dedup.op8_embedding_dedup,
        decontamination.op9_benchmark_decontamination,
        window_dedup.op10_window_dedup,
        pii.op11_pii_bootstrap,
        conversation_repair.op12_conversation_repair,
        merkle.op13_merkle_manifest,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_secret_scan": secret_scan.ORACLE_SQL,
        "op4_line_dedup": line_dedup.ORACLE_SQL,
        "op7_ngram_jaccard": ngram_join.ORACLE_SQL,
        "op8_embedding_dedup": embedding_dedup.ORACLE_SQL,
        "op9_benchmark_decontamination": decontamination.ORACLE_SQL,
        "op11_pii_bootstrap": pii.ORACLE_SQL,
        "op12_conversation_repair": conversation_repair.ORACLE_SQL,
        "op13_merkle_manifest": merkle.ORACLE_SQL,
    }
