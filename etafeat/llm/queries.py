"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from etafeat.llm import (
    chat_format, decontamination, embedding_dedup, fill_middle, html_text, language_model, line_dedup, packing, phrases,
    quality, simhash, source_mixing, url_filter)

QUERIES = {
    "op1_embedding_near_dedup": embedding_dedup.op1_embedding_near_dedup,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_simhash_near_dedup": simhash.op4_simhash_near_dedup,
    "op5_benchmark_decontamination": decontamination.op5_benchmark_decontamination,
    "op6_lm_scoring": language_model.op6_lm_scoring,
    "op7_source_mixing": source_mixing.op7_source_mixing,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_html_extraction": html_text.op9_html_extraction,
    "op10_chat_formatting": chat_format.op10_chat_formatting,
    "op11_best_fit_packing": packing.op11_best_fit_packing,
    "op12_fill_in_middle": fill_middle.op12_fill_in_middle,
    "op13_phrase_mining": phrases.op13_phrase_mining,
}
SQL = {
    "op1_embedding_near_dedup": embedding_dedup.SQL,
    "op2_url_filter": url_filter.SQL,
    "op7_source_mixing": source_mixing.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op12_fill_in_middle": fill_middle.SQL,
    "op13_phrase_mining": phrases.SQL,
}
