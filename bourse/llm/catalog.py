"""Queries and oracle SQL of this subpackage, by name."""

from __future__ import annotations

import corpus_pipeline
from bourse.llm import (arc, burst_trie, decontaminate, hilbert, license_scan, line_dedup, packing, periodic, pii, simhash, toxicity,
                        vptree, zstd_quality)

QUERIES = {
    "op1_pii_boosting": pii.op1_pii_boosting,
    "op2_vptree": vptree.op2_vptree,
    "op3_zstd_quality": zstd_quality.op3_zstd_quality,
    "op4_cnn_toxicity": toxicity.op4_cnn_toxicity,
    "op5_license_index": license_scan.op5_license_index,
    "op6_line_chunks": line_dedup.op6_line_chunks,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_hilbert_shards": hilbert.op8_hilbert_shards,
    "op9_simhash_golay": simhash.op9_simhash_golay,
    "op10_bm25_packing": packing.op10_bm25_packing,
    "op11_arc_to_warc": arc.op11_arc_to_warc,
    "op12_burst_trie": burst_trie.op12_burst_trie,
    "op13_basic_factors": periodic.op13_basic_factors,
    "pipeline": corpus_pipeline.pipeline,
}

ORACLE: dict[str, str] = {}
