"""The queries of this subpackage, and SQL that gives the same rows where SQL can."""

from . import chat, decontam, importance, licences, neardup, packing, quality, sharding, spelling, store, suffix, tokencount, trie


def queries() -> dict:
    return {
        "op1_near_dup": neardup.near_dup_query,
        "op2_token_store": store.tokenize_documents,
        "op3_hash_tree_shards": sharding.shard_query,
        "op4_decontaminate": decontam.decontam_query,
        "op5_licence_scan": licences.licence_query,
        "op6_suffix_dedup": suffix.suffix_query,
        "op7_quality_perplexity": quality.quality_query,
        "op8_chat_format": chat.chat_query,
        "op9_pack_first_fit": packing.pack_query,
        "op10_importance": importance.importance_query,
        "op11_prefix_trie": trie.trie_query,
        "op12_spelling": spelling.spelling_query,
        "op13_token_counts": tokencount.token_count_query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_hash_tree_shards": sharding.shard_sql(), "op8_chat_format": chat.CHAT_SQL, "op11_prefix_trie": trie.TRIE_SQL, "op12_spelling": spelling.SPELLING_SQL}
