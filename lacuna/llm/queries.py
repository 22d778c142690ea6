"""Queries of this subpackage and their DuckDB SQL, by name."""

from __future__ import annotations

from . import (
    chat_format, embedding_dedup, html_text, line_dedup, mixing, ngram_join, packing,
    periodic_runs, quality_model, quality_rules, substring_dedup, token_counts,
    turn_repair,
)

QUERIES = {
    "op1_embedding_dedup": (embedding_dedup.op1_embedding_dedup, embedding_dedup.OP1_SQL),
    "op2_quality_classifier": (quality_model.op2_quality_classifier, None),
    "op3_line_dedup": (line_dedup.op3_line_dedup, None),
    "op4_source_mixing": (mixing.op4_source_mixing, mixing.OP4_SQL),
    "op5_substring_dedup": (substring_dedup.op5_substring_dedup, substring_dedup.OP5_SQL),
    "op6_packing": (packing.op6_packing, None),
    "op7_ngram_join": (ngram_join.op7_ngram_join, ngram_join.OP7_SQL),
    "op8_quality_rules": (quality_rules.op8_quality_rules, quality_rules.OP8_SQL),
    "op9_html_extraction": (html_text.op9_html_extraction, None),
    "op10_chat_format": (chat_format.op10_chat_format, chat_format.OP10_SQL),
    "op11_token_counts": (token_counts.op11_token_counts, None),
    "op12_conversation_repair": (turn_repair.op12_conversation_repair, None),
    "op13_periodic_runs": (periodic_runs.op13_periodic_runs, None),
}
