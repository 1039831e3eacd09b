"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from barline.llm import (block_labeller, graph_dedup, host_rules, jaccard_join, ngram_lm, packing, periodic_runs, pieces,
                         prefix_forest, secret_scan, spelling_groups, toxicity, url_filter)

QUERIES = {
    "op1_block_labeller": block_labeller.op1_block_labeller,
    "op2_quality_rules": host_rules.op2_quality_rules,
    "op3_ngram_quality": ngram_lm.op3_ngram_quality,
    "op4_prefix_forest": prefix_forest.op4_prefix_forest,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_jaccard_join": jaccard_join.op6_jaccard_join,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_pieces": pieces.op8_pieces,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_graph_dedup": graph_dedup.op11_graph_dedup,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_spelling_groups": spelling_groups.op13_spelling_groups,
}

ORACLES = {
    "op2_quality_rules": host_rules.SQL,
    "op6_jaccard_join": jaccard_join.SQL,
    "op9_url_filter": url_filter.SQL,
    "op11_graph_dedup": graph_dedup.SQL,
}
