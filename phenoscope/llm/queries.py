"""Queries of this folder and their DuckDB SQL, for the registry."""

from __future__ import annotations

from .chat import OP7_SQL, op7_chat_formatting
from .decontam import OP3_SQL, op3_benchmark_decontamination
from .divergence import OP11_SQL, op11_source_divergence
from .filter_audit import OP13_SQL, op13_filter_audit
from .html_text import op1_html_extraction
from .language import op2_language_id
from .lines import OP4_SQL, op4_line_dedup
from .mixing import OP8_SQL, op8_source_mixing
from .pii import op9_personal_data
from .simhash import op5_simhash_near_dedup
from .suffix import op6_suffix_dedup
from .syncmers import op10_document_fingerprints
from .token_files import op12_token_files

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_language_id": op2_language_id,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_source_mixing": op8_source_mixing,
    "op9_personal_data": op9_personal_data,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_source_divergence": op11_source_divergence,
    "op12_token_files": op12_token_files,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE = {
    "op3_benchmark_decontamination": OP3_SQL,
    "op4_line_dedup": OP4_SQL,
    "op7_chat_formatting": OP7_SQL,
    "op8_source_mixing": OP8_SQL,
    "op11_source_divergence": OP11_SQL,
    "op13_filter_audit": OP13_SQL,
}
