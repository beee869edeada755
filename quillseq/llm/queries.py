"""Queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from quillseq.llm import chat_format, decontaminate, lm_scoring, merkle, mixing, ngram_join, packing, prefix_trie, quality_rules, substring_dedup, token_counts, token_file, toxicity


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_quality_rules": quality_rules.op2_quality_rules,
        "op3_mixing": mixing.op3_mixing,
        "op4_substring_dedup": substring_dedup.op4_substring_dedup,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_ngram_join": ngram_join.op6_ngram_join,
        "op6_ngram_links": ngram_join.op6_ngram_links,
        "op7_token_file": token_file.op7_token_file,
        "op8_token_counts": token_counts.op8_token_counts,
        "op9_chat_formatting": chat_format.op9_chat_formatting,
        "op10_lm_scoring": lm_scoring.op10_lm_scoring,
        "op11_merkle_manifest": merkle.op11_merkle_manifest,
        "op12_prefix_trie": prefix_trie.op12_prefix_trie,
        "op13_packing": packing.op13_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": mixing.ORACLE, "op6_ngram_join": ngram_join.ORACLE, "op6_ngram_links": ngram_join.LINKS_ORACLE, "op9_chat_formatting": chat_format.ORACLE, "op11_merkle_manifest": merkle.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE}
