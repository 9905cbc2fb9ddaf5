"""The queries of this subpackage and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from galley.llm import bucket_pair, chunk_dedup, decontaminate, langid, merkle, mixing, neardup, quality, spm, tokencount, topk, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": url_filter.op1_url_filters,
        "op2_exact_top_k": topk.op2_exact_top_k,
        "op3_substring_dedup": chunk_dedup.op3_substring_dedup,
        "op4_quality_rules": quality.op4_quality_rules,
        "op5_language_id": langid.op5_language_id,
        "op6_near_duplicates": neardup.op6_near_duplicates,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_sentencepiece": spm.op8_sentencepiece,
        "op9_token_counts": tokencount.op9_token_counts,
        "op10_source_mix": mixing.op10_source_mix,
        "op11_decontaminate": decontaminate.op11_decontaminate,
        "op12_bucketed_pair": bucket_pair.op12_bucketed_pair,
        "op13_merkle_manifest": merkle.op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filters": url_filter.OP1_SQL,
        "op2_exact_top_k": topk.OP2_SQL,
        "op4_quality_rules": quality.OP4_SQL,
        "op11_decontaminate": decontaminate.OP11_SQL,
        "op13_merkle_manifest": merkle.OP13_SQL,
    }
