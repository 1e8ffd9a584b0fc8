"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from . import (bpe, chat_query, decontam, langid, mixing, near, pu, quality_rules, ranked, sharding_query, suffix, toxicity,
               variants)

QUERIES = {
    "op1_near_duplicates": near.op1_near_duplicates,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_pu_quality": pu.op3_pu_quality,
    "op4_chat_format": chat_query.op4_chat_format,
    "op5_suffix_dedup": suffix.op5_suffix_dedup,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_decontamination": decontam.op7_decontamination,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_shards": sharding_query.op9_shards,
    "op10_language_id": langid.op10_language_id,
    "op11_spelling_variants": variants.op11_spelling_variants,
    "op12_source_mix": mixing.op12_source_mix,
    "op13_ranked_search": ranked.op13_ranked_search,
}
ORACLE_SQL = {
    "op2_quality_rules": quality_rules.ORACLE,
    "op4_chat_format": chat_query.ORACLE,
    "op9_shards": sharding_query.ORACLE,
    "op11_spelling_variants": variants.ORACLE,
    "op12_source_mix": mixing.ORACLE,
    "op13_ranked_search": ranked.ORACLE,
}
