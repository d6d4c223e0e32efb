"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from quarrymill.llm import chat, media, mixing, near_dedup, packing, prefix_trie, quality, ranked_search, sharding, substring_dedup, token_files, topk, toxicity

QUERIES = {
    "op1_norm_bucketed_topk": topk.op1_norm_bucketed_topk,
    "op2_mpeg_audio": media.op2_mpeg_audio,
    "op3_attention_mil_quality": quality.op3_attention_mil_quality,
    "op4_extendible_sharding": sharding.op4_extendible_sharding,
    "op5_minhash_near_dedup": near_dedup.op5_minhash_near_dedup,
    "op6_toxicity_chain": toxicity.op6_toxicity_chain,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_ipf_mixing": mixing.op8_ipf_mixing,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_token_files": token_files.op11_token_files,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_threshold_search": ranked_search.op13_threshold_search,
    # Operator 4 at a limit that parts small tables into many shards, and its directory.
    "shards_of_64k": sharding.small_shards,
    "shard_directory_of_64k": sharding.small_directory,
}

ORACLES: dict[str, str] = {
    "op1_norm_bucketed_topk": topk.ORACLE,
    "op4_extendible_sharding": sharding.ORACLE,
    "op5_minhash_near_dedup": near_dedup.ORACLE,
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op9_chat_formatting": chat.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_threshold_search": ranked_search.ORACLE,
    "shards_of_64k": sharding.SMALL_ORACLE,
    "shard_directory_of_64k": sharding.DIRECTORY_ORACLE,
}
