"""Registered queries of this subpackage and their reference SQL."""

from __future__ import annotations

from pricetide.llm import (
    filter_audit,
    html_text,
    importance,
    mixing,
    ngram_join,
    personal_data,
    quality_rules,
    sentencepieces,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_files,
    warc,
)


def registered() -> dict:
    return {
        "op1_suffix_array_dedup": suffix_dedup.op1_suffix_array_dedup,
        "op2_quality_rules": quality_rules.op2_quality_rules,
        "op3_token_files": token_files.op3_token_files,
        "op4_simhash": simhash.op4_simhash,
        "op5_substring_dedup": substring_dedup.op5_substring_dedup,
        "op6_sentencepiece": sentencepieces.op6_sentencepiece,
        "op7_source_mixing": mixing.op7_source_mixing,
        "op8_html_extraction": html_text.op8_html_extraction,
        "op9_ngram_jaccard_join": ngram_join.op9_ngram_jaccard_join,
        "op10_warc": warc.op10_warc,
        "op11_importance_resampling": importance.op11_importance_resampling,
        "op12_filter_audit": filter_audit.op12_filter_audit,
        "op13_pii_spans": personal_data.op13_pii_spans,
    }


def statements() -> dict[str, str]:
    return {
        "op1_suffix_array_dedup": suffix_dedup.SQL,
        "op2_quality_rules": quality_rules.SQL,
        "op5_substring_dedup": substring_dedup.SQL,
        "op7_source_mixing": mixing.SQL,
        "op9_ngram_jaccard_join": ngram_join.SQL,
        "op10_warc": warc.SQL,
        "op11_importance_resampling": importance.SQL,
        "op12_filter_audit": filter_audit.SQL,
        "op13_pii_spans": personal_data.SQL,
    }
