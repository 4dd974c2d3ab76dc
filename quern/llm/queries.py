"""The subpackage's queries and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from quern.llm import bpe, chat, decontamination, exact_dedup, hard_negatives, mixing, ngram_join, prefix_trie, quality, suffix_dedup, token_counts, toxicity, url_filter

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_bpe": bpe.op3_bpe,
    "op4_ngram_jaccard": ngram_join.op4_ngram_jaccard,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_url_filters": url_filter.op6_url_filters,
    "op7_quality_classifier": quality.op7_quality_classifier,
    "op8_chat_formatting": chat.op8_chat_formatting,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_source_mix": mixing.op12_source_mix,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

SQL = {
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op4_ngram_jaccard": ngram_join.OP4_SQL,
    "op8_chat_formatting": chat.OP8_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_source_mix": mixing.OP12_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
