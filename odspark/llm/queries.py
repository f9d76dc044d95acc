"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from odspark.llm import (
    collocations, decontamination, filter_audit, html_extraction, license_scan, ngram_join, quality_rules, secret_scan, sentencepiece_codec, source_mix, token_counts,
    token_files, url_filter,
)

QUERIES = {
    "op1_decontamination": decontamination.query,
    "op2_ngram_jaccard_join": ngram_join.query,
    "op3_secret_scan": secret_scan.query,
    "op4_html_extraction": html_extraction.query,
    "op5_license_scan": license_scan.query,
    "op6_token_files": token_files.query,
    "op7_token_counts": token_counts.query,
    "op8_sentencepiece": sentencepiece_codec.query,
    "op9_quality_rules": quality_rules.query,
    "op10_url_filter": url_filter.query,
    "op11_collocations": collocations.query,
    "op12_source_mix": source_mix.query,
    "op13_filter_audit": filter_audit.query,
}

ORACLE: dict[str, str] = {
    "op1_decontamination": decontamination.ORACLE,
    "op2_ngram_jaccard_join": ngram_join.ORACLE,
    "op3_secret_scan": secret_scan.ORACLE,
    "op5_license_scan": license_scan.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_source_mix": source_mix.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
