"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from clearspan.llm import credentials, curriculum, extraction, jaccard, keyed, lexical, linedup, mixing, packing, quality, toxicity, trie, vectors

QUERIES = {
    "op1_line_dedup": linedup.op1_line_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_context_mixing": mixing.op3_context_mixing,
    "op4_mix_sources": curriculum.op4_mix_sources,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_exact_top_k": vectors.op7_exact_top_k,
    "op8_pack_documents": packing.op8_pack_documents,
    "op9_keyed_token_files": keyed.op9_keyed_token_files,
    "op10_main_text": extraction.op10_main_text,
    "op11_secret_spans": credentials.op11_secret_spans,
    "op12_lexical_search": lexical.op12_lexical_search,
    "op13_prefix_trie": trie.op13_prefix_trie,
}

ORACLE = {
    "op1_line_dedup": linedup.OP1_SQL,
    "op5_quality_rules": quality.OP5_SQL,
    "op6_jaccard_join": jaccard.OP6_SQL,
    "op7_exact_top_k": vectors.OP7_SQL,
    "op12_lexical_search": lexical.OP12_SQL,
    "op13_prefix_trie": trie.OP13_SQL,
}
