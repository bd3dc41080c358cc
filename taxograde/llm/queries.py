"""Queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from . import (bpe, chat_rotation, decontaminate, lang_id, main_text, multiset_hash, near_dedup, passages, ranked_search,
               secrets_scan, spelling, token_files, toxicity)

QUERIES = {
    "op1_dart_minhash": near_dedup.op1_dart_minhash,
    "op2_elias_fano_files": token_files.op2_elias_fano_files,
    "op3_multiset_hash": multiset_hash.op3_multiset_hash,
    "op4_folded_lexicon": toxicity.op4_folded_lexicon,
    "op5_heap_bpe": bpe.op5_heap_bpe,
    "op6_collinear_chains": passages.op6_collinear_chains,
    "op7_size_partitioned_containment": decontaminate.op7_size_partitioned_containment,
    "op8_cross_parsing": lang_id.op8_cross_parsing,
    "op9_perspective_rotation": chat_rotation.op9_perspective_rotation,
    "op10_token_efficiency": secrets_scan.op10_token_efficiency,
    "op11_line_blocks": main_text.op11_line_blocks,
    "op12_limited_accumulators": ranked_search.op12_limited_accumulators,
    "op13_bit_sliced_variants": spelling.op13_bit_sliced_variants,
}
ORACLES: dict[str, str] = {
    "op3_multiset_hash": multiset_hash.ORACLE,
    "op7_size_partitioned_containment": decontaminate.ORACLE,
    "op9_perspective_rotation": chat_rotation.ORACLE,
    "op11_line_blocks": main_text.ORACLE,
    "op12_limited_accumulators": ranked_search.ORACLE,
}
