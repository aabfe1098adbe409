"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from paddock.llm import (
    conversation_repair,
    decontamination,
    html_text,
    importance_resampling,
    language_id,
    mixing,
    near_dup,
    quality_classifier,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
    token_output,
)

QUERIES = {
    "op1_token_counts": token_counts.query,
    "op2_suffix_dedup": suffix_dedup.query,
    "op3_quality_classifier": quality_classifier.query,
    "op4_token_output": token_output.query,
    "op5_decontamination": decontamination.query,
    "op6_mixing": mixing.query,
    "op7_near_dup": near_dup.query,
    "op8_html_text": html_text.query,
    "op9_language_id": language_id.query,
    "op10_quality_rules": quality_rules.query,
    "op11_simhash": simhash.query,
    "op12_conversation_repair": conversation_repair.query,
    "op13_importance_resampling": importance_resampling.query,
}

ORACLES: dict[str, str] = {
    "op5_decontamination": decontamination.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op7_near_dup": near_dup.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op12_conversation_repair": conversation_repair.ORACLE,
    "op13_importance_resampling": importance_resampling.ORACLE,
}
