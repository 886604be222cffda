"""Registered queries of the subpackage and their DuckDB counterparts."""

from __future__ import annotations

from fitframe.llm import (conversation_trie, decontamination, language_id, ngram_join, quality_model, quality_rules, quote_linking,
                           secret_scan, sentencepiece_bpe, token_count, toxicity_crf, warc, whitening)

QUERIES = {
    "op1_warc": warc.run_query,
    "op2_secret_scan": secret_scan.run_query,
    "op3_decontamination": decontamination.run_query,
    "op4_sentencepiece": sentencepiece_bpe.run_query,
    "op5_token_counts": token_count.run_query,
    "op6_ngram_jaccard": ngram_join.run_query,
    "op7_quality_qda": quality_model.run_query,
    "op8_quality_rules": quality_rules.run_query,
    "op9_quote_linking": quote_linking.run_query,
    "op10_language_id": language_id.run_query,
    "op11_conversation_trie": conversation_trie.run_query,
    "op12_embedding_whitening": whitening.run_query,
    "op13_toxicity_crf": toxicity_crf.run_query,
}

# Operators whose result SQL can state; the others are held against
# brute-force versions in tests/llm.
ORACLE = {
    "op1_warc": warc.ORACLE,
    "op6_ngram_jaccard": ngram_join.ORACLE,
    "op8_quality_rules": quality_rules.oracle(),
    "op11_conversation_trie": conversation_trie.ORACLE,
}
