"""The queries of this package and the DuckDB SQL that checks them."""

from __future__ import annotations

from . import (
    divergence,
    fill_middle,
    lm_scores,
    mixing,
    ngram_join,
    packing,
    quality,
    secret_scan,
    sharding,
    simhash,
    token_counts,
    topk,
    toxicity,
)

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_topk_search": topk.op3_topk_search,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_mixing": mixing.op5_mixing,
    "op6_packing": packing.op6_packing,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_secrets": secret_scan.op8_secrets,
    "op9_simhash": simhash.op9_simhash,
    "op10_lm_scores": lm_scores.op10_lm_scores,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_ngram_join": ngram_join.op12_ngram_join,
    "op13_divergence": divergence.op13_divergence,
}

#: Where SQL can't express an operator, tests/llm holds it against brute force.
ORACLES = {
    "op1_sharding": sharding.OP1_SQL,
    "op2_quality_rules": quality.OP2_SQL,
    "op3_topk_search": topk.OP3_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op11_fill_middle": fill_middle.OP11_SQL,
    "op12_ngram_join": ngram_join.OP12_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
