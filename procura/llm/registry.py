"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from procura.llm import decontaminate, divergence, lines, secret_scan, substrings, urls, vector_codes
from procura.llm.decontaminate import op10_benchmark_decontamination
from procura.llm.divergence import op11_source_divergence
from procura.llm.extraction import op2_html_extraction
from procura.llm.language import op7_language_id
from procura.llm.lines import op12_line_dedup
from procura.llm.packing import op1_best_fit_packing
from procura.llm.quality import op9_quality_classifier
from procura.llm.rules import op8_quality_rules
from procura.llm.secret_scan import op3_secret_scans
from procura.llm.simhash import op4_simhash_near_dedup
from procura.llm.substrings import op6_substring_dedup
from procura.llm.urls import op5_url_filters
from procura.llm.vector_codes import op13_vector_codes

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_html_extraction": op2_html_extraction,
    "op3_secret_scans": op3_secret_scans,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_url_filters": op5_url_filters,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_source_divergence": op11_source_divergence,
    "op12_line_dedup": op12_line_dedup,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL: dict[str, str] = {
    "op3_secret_scans": secret_scan.SQL,
    "op5_url_filters": urls.SQL,
    "op6_substring_dedup": substrings.SQL,
    "op10_benchmark_decontamination": decontaminate.SQL,
    "op11_source_divergence": divergence.SQL,
    "op12_line_dedup": lines.SQL,
    "op13_vector_codes": vector_codes.SQL,
}
