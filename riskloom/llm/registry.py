"""Queries of the subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from riskloom.llm import alignment, bpe, chat_format, decontaminate, jaccard_join, language_id, license_scan, mixing, oracles, quality_classifier, quality_rules, runs, substring_dedup, warc


def queries() -> dict[str, Callable[..., DataFrame]]:
    return {
        "op1_substring_dedup": substring_dedup.op1_substring_dedup,
        "op2_chat_format": chat_format.op2_chat_format,
        "op3_bpe": bpe.op3_bpe,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_language_id": language_id.op5_language_id,
        "op6_warc": warc.op6_warc,
        "op7_quality_classifier": quality_classifier.op7_quality_classifier,
        "op8_jaccard_join": jaccard_join.op8_jaccard_join,
        "op9_license_scan": license_scan.op9_license_scan,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_source_mix": mixing.op11_source_mix,
        "op12_periodic_runs": runs.op12_periodic_runs,
        "op13_tokenizer_alignment": alignment.op13_tokenizer_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
