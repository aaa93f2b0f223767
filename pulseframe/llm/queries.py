"""Queries of the text operators and their SQL."""

from __future__ import annotations

from . import (
    chat_format,
    compression_classifier,
    decontamination,
    hard_negatives,
    jaccard_join,
    language_id,
    license_scan,
    masked_lm,
    packing,
    prefix_trie,
    quality_rules,
    surrogates,
    warc,
)

QUERIES = {
    "op1_masked_lm_scores": masked_lm.query,
    "op2_decontamination": decontamination.query,
    "op3_chat_format": chat_format.query,
    "op4_warc_bundles": warc.query,
    "op5_compression_quality": compression_classifier.query,
    "op6_best_fit_packing": packing.query,
    "op7_jaccard_join": jaccard_join.query,
    "op8_quality_rules": quality_rules.query,
    "op9_surrogates": surrogates.query,
    "op10_language_id": language_id.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_license_scan": license_scan.query,
    "op13_prefix_trie": prefix_trie.query,
}

SQL = {
    "op2_decontamination": decontamination.SQL,
    "op3_chat_format": chat_format.SQL,
    "op4_warc_bundles": warc.SQL,
    "op7_jaccard_join": jaccard_join.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_license_scan": license_scan.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
