"""The registered queries of the operators, with the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from docvault.llm import (chat, embedding_links, fill_in_middle, html_main, line_dedup, mixing, packing, piece_encoding,
                          quality_rules, simhash, source_divergence, substring_dedup, token_files)

MODULES = {
    "op1_quality_rules": quality_rules,
    "op2_mixing": mixing,
    "op3_simhash": simhash,
    "op4_embedding_links": embedding_links,
    "op5_line_dedup": line_dedup,
    "op6_chat": chat,
    "op7_token_files": token_files,
    "op8_substring_dedup": substring_dedup,
    "op9_html_main": html_main,
    "op10_packing": packing,
    "op11_source_divergence": source_divergence,
    "op12_piece_encoding": piece_encoding,
    "op13_fill_in_middle": fill_in_middle,
}

QUERIES = {name: m.query for name, m in MODULES.items()}
SQL = {name: m.SQL for name, m in MODULES.items() if m.SQL is not None}
