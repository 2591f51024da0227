"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from martloom.llm import (
    decontamination,
    divergence,
    exact_dedup,
    language_id,
    language_model,
    licenses,
    mixing,
    neardup,
    pii,
    prefix_trie,
    sharding,
    substring,
    topk,
)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_odd_sketch_neardup": neardup.op2_odd_sketch_neardup,
    "op3_feistel_sharding": sharding.op3_feistel_sharding,
    "op4_bloom_lm": language_model.op4_bloom_lm,
    "op5_seed_alignment": decontamination.op5_seed_alignment,
    "op6_rake_mixture": mixing.op6_rake_mixture,
    "op7_pivot_topk": topk.op7_pivot_topk,
    "op8_hierarchical_langid": language_id.op8_hierarchical_langid,
    "op9_suffix_dedup": substring.op9_suffix_dedup,
    "op10_feistel_pseudonyms": pii.op10_feistel_pseudonyms,
    "op11_bloom_exact_dedup": exact_dedup.op11_bloom_exact_dedup,
    "op12_divergence_audit": divergence.op12_divergence_audit,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLES = {
    "op2_odd_sketch_neardup": neardup.oracle_sql,
    "op3_feistel_sharding": sharding.oracle_sql,
    "op6_rake_mixture": mixing.oracle_sql,
    "op7_pivot_topk": topk.oracle_sql,
    "op9_suffix_dedup": substring.oracle_sql,
    "op11_bloom_exact_dedup": exact_dedup.oracle_sql,
    "op12_divergence_audit": divergence.oracle_sql,
    "op13_prefix_trie": prefix_trie.oracle_sql,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql() for name, sql in ORACLES.items()}
