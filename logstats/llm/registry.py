"""The queries of the numbered operators, and SQL to compare them with."""

from __future__ import annotations

from logstats.llm import (
    decontamination,
    hamming_search,
    jaccard_join,
    language,
    mixing,
    pieces,
    pii,
    ranking,
    sharding,
    spelling,
    urls,
    warc,
    wrappers,
)

QUERIES = {
    "op1_wrapper_text": wrappers.op1_wrapper_text,
    "op2_systematic_mix": mixing.op2_systematic_mix,
    "op3_hamming_top_k": hamming_search.op3_hamming_top_k,
    "op4_hilbert_shards": sharding.op4_hilbert_shards,
    "op5_simhash_leaks": decontamination.op5_simhash_leaks,
    "op6_rank_order": language.op6_rank_order,
    "op7_url_models": urls.op7_url_models,
    "op8_surrogates": pii.op8_surrogates,
    "op9_size_aware_join": jaccard_join.op9_size_aware_join,
    "op10_zip_warc": warc.op10_zip_warc,
    "op11_position_bitsets": spelling.op11_position_bitsets,
    "op12_chunk_table": pieces.op12_chunk_table,
    "op13_fp_tree_search": ranking.op13_fp_tree_search,
}
ORACLES = {
    "op2_systematic_mix": mixing.ORACLE,
    "op3_hamming_top_k": hamming_search.ORACLE,
    "op5_simhash_leaks": decontamination.ORACLE,
    "op10_zip_warc": warc.ORACLE,
    "op11_position_bitsets": spelling.ORACLE,
    "op13_fp_tree_search": ranking.ORACLE,
}
