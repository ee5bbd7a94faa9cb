"""The registered queries of the corpus operators and their SQL where SQL can say it."""

from __future__ import annotations

from . import (exact_dedup, fingerprints, line_dedup, merkle, mixing, packing, prefix_trie, rule_quality, simhash_dedup,
               token_counts, token_files, toxicity, url_filter)

QUERIES = {
    "op1_simhash_dedup": simhash_dedup.query,
    "op2_toxicity": toxicity.query,
    "op3_fingerprints": fingerprints.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_line_dedup": line_dedup.query,
    "op6_mixing": mixing.query,
    "op7_url_filter": url_filter.query,
    "op8_packing": packing.query,
    "op9_token_counts": token_counts.query,
    "op10_token_files": token_files.query,
    "op11_rule_quality": rule_quality.query,
    "op12_merkle_manifest": merkle.query,
    "op13_prefix_trie": prefix_trie.query,
}

ORACLE = {"op4_exact_dedup": exact_dedup.SQL, "op12_merkle_manifest": merkle.SQL, "op13_prefix_trie": prefix_trie.SQL}
