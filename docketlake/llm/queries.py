"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from docketlake.llm import decontamination, jaccard_join, lm_scoring, quality_classifier, quality_rules, secret_scan, source_mixing, substring_dedup, token_output, warc_revisits

QUERIES = {
    "op1_quality_classifier": quality_classifier.op1_quality_classifier,
    "op2_lm_scoring": lm_scoring.op2_lm_scoring,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_warc_revisits": warc_revisits.op5_warc_revisits,
    "op6_token_output": token_output.op6_token_output,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_source_mixing": source_mixing.op10_source_mixing,
}

ORACLES: dict[str, str] = {
    "op3_jaccard_join": jaccard_join.ORACLE,
    "op4_substring_dedup": substring_dedup.ORACLE,
    "op8_quality_rules": quality_rules.ORACLE,
    "op9_secret_scan": secret_scan.ORACLE,
    "op5_warc_revisits": warc_revisits.ORACLE,
    "op10_source_mixing": source_mixing.ORACLE,
}
