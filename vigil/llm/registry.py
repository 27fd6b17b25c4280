"""Driver queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from vigil.llm import (decontaminate, html_text, mixing, near_dedup, personal_data, pieces, quality, structure, substring_dedup, token_files,
                       toxicity, trie, url_filter)

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_toxicity": toxicity.query,
    "op3_near_dedup": near_dedup.query,
    "op4_html_text": html_text.query,
    "op5_mixing": mixing.query,
    "op6_token_files": token_files.query,
    "op7_personal_data": personal_data.query,
    "op8_quality_rules": quality.query,
    "op9_url_filter": url_filter.query,
    "op10_substring_dedup": substring_dedup.query,
    "op11_prefix_trie": trie.query,
    "op12_sentencepiece": pieces.query,
    "op13_structure_repair": structure.query,
}
ORACLE = {
    "op3_near_dedup": near_dedup.ORACLE,
    "op8_quality_rules": quality.ORACLE,
    "op9_url_filter": url_filter.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op11_prefix_trie": trie.ORACLE,
    "op13_structure_repair": structure.ORACLE,
}
