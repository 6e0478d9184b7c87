"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from transitlake.llm import (
    bpe,
    chat,
    ctw,
    fingerprints,
    fixity,
    manifest,
    mixing,
    neardup,
    packing,
    pii,
    quality,
    repair,
    toxicity,
)

QUERIES = {
    "op1_order_minhash": fingerprints.query,
    "op2_bootstrapped_contexts": pii.query,
    "op3_sentencepiece_bpe": bpe.query,
    "op4_prob_minhash": neardup.query,
    "op5_perspectives": chat.query,
    "op6_context_trees": ctw.query,
    "op7_cutting_stock": packing.query,
    "op8_boosted_trees": toxicity.query,
    "op9_line_frequency": quality.query,
    "op10_merkle_audit": fixity.query,
    "op11_suffix_dawg": repair.query,
    "op12_pivotal_mix": mixing.query,
    "op13_butterfly_manifest": manifest.query,
}

SQL = {
    "op5_perspectives": chat.ORACLE,
    "op9_line_frequency": quality.ORACLE,
    "op10_merkle_audit": fixity.ORACLE,
    "op13_butterfly_manifest": manifest.ORACLE,
}
