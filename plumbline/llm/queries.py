"""The queries of this package and their SQL twins."""

from __future__ import annotations

from plumbline.llm import centroids, chat, collocations, fingerprints, licenses, mixing, pieces, pivots, quality, sharding, sketches, suffix, toxicity

QUERIES = {
    "op1_line_crf": quality.op1_line_crf,
    "op2_setsketch": sketches.op2_setsketch,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_suffix_array": suffix.op4_suffix_array,
    "op5_prefix_tree": chat.op5_prefix_tree,
    "op6_pieces": pieces.op6_pieces,
    "op7_pivot_index": pivots.op7_pivot_index,
    "op8_bigru": toxicity.op8_bigru,
    "op9_uniform_shards": sharding.op9_uniform_shards,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_setm_phrases": collocations.op11_setm_phrases,
    "op12_order_minhash": fingerprints.op12_order_minhash,
    "op13_vantage_kmeans": centroids.op13_vantage_kmeans,
}

ORACLE_SQL = {
    "op5_prefix_tree": chat.OP5_SQL,
    "op2_setsketch": sketches.OP2_SQL,
    "op7_pivot_index": pivots.OP7_SQL,
    "op10_mix_sources": mixing.OP10_SQL,
    "op11_setm_phrases": collocations.OP11_SQL,
    "op13_vantage_kmeans": centroids.OP13_SQL,
}
