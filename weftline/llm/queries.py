"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from weftline.llm import conversation_repair, decontamination, exact_dedup, importance, jaccard, language_id, mixing, packing, pii, quality_classifier, quality_rules, secret_scan, toxicity

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_mixing": mixing.op2_mixing,
    "op3_language_id": language_id.op3_language_id,
    "op4_quality_classifier": quality_classifier.op4_quality_classifier,
    "op5_jaccard": jaccard.op5_jaccard,
    "op6_secret_scan": secret_scan.op6_secret_scan,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_pii": pii.op9_pii,
    "op10_packing": packing.op10_packing,
    "op11_decontamination": decontamination.op11_decontamination,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_importance": importance.op13_importance,
}

ORACLES = {"op2_mixing": mixing.ORACLE, "op8_exact_dedup": exact_dedup.ORACLE, "op11_decontamination": decontamination.ORACLE, "op12_conversation_repair": conversation_repair.ORACLE}
