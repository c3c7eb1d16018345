"""The registered queries of the corpus operators and the SQL of those that have one."""

from __future__ import annotations

from cratelight.llm import conversations, dedup, language, lines, mixing, packing, phrases, quality, shards, toxicity, urls, vectors, warc

QUERIES = {
    "op1_multi_index": vectors.op1_multi_index,
    "op2_swap_packing": packing.op2_swap_packing,
    "op3_naive_bayes": language.op3_naive_bayes,
    "op4_bag_minhash": dedup.op4_bag_minhash,
    "op5_gru_attention": toxicity.op5_gru_attention,
    "op6_golden_mix": mixing.op6_golden_mix,
    "op7_bloom_cascade": urls.op7_bloom_cascade,
    "op8_jump_hash": shards.op8_jump_hash,
    "op9_seekable_warc": warc.op9_seekable_warc,
    "op10_ngram_ratio": quality.op10_ngram_ratio,
    "op11_zfast_trie": conversations.op11_zfast_trie,
    "op12_line_ranges": lines.op12_line_ranges,
    "op13_fm_phrases": phrases.op13_fm_phrases,
}
SQL = {
    "op6_golden_mix": mixing.OP6_SQL,
    "op7_bloom_cascade": urls.OP7_SQL,
    "op9_seekable_warc": warc.OP9_SQL,
    "op11_zfast_trie": conversations.OP11_SQL,
    "op12_line_ranges": lines.OP12_SQL,
    "op13_fm_phrases": phrases.OP13_SQL,
}
