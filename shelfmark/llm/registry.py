"""Queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from shelfmark.llm import (
    bpe,
    hnsw,
    language,
    mixing,
    packing,
    pages,
    quality,
    simhash,
    suffix,
    tokencount,
    trie,
    variants,
    windows,
)

QUERIES = {
    "op1_token_counts": tokencount.op1_token_counts,
    "op2_simhash": simhash.op2_simhash,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_embedding_dedup": hnsw.op4_embedding_dedup,
    "op5_html_extraction": pages.op5_html_extraction,
    "op6_passage_dedup": windows.op6_passage_dedup,
    "op7_suffix_dedup": suffix.op7_suffix_dedup,
    "op8_mixing": mixing.op8_mixing,
    "op9_bpe": bpe.op9_bpe,
    "op10_language_id": language.op10_language_id,
    "op11_prefix_trie": trie.op11_prefix_trie,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_packing": packing.op13_packing,
}

SQL = {
    "op3_quality_rules": quality.SQL,
    "op8_mixing": mixing.SQL,
}
