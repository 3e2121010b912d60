"""The registered queries of this subpackage and the SQL that checks them, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from namewake.llm import (
    chunk_bpe,
    conversation_repair,
    disclosure,
    huffman_files,
    jaccard_join,
    mixing,
    prefix_trie,
    quality_model,
    quality_rules,
    sharding,
    topk_search,
    toxicity,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": url_filters.query,
    "op2_source_mixing": mixing.query,
    "op3_quality_model": quality_model.query,
    "op4_toxicity": toxicity.query,
    "op5_jaccard_join": jaccard_join.query,
    "op6_topk_search": topk_search.query,
    "op7_huffman_files": huffman_files.query,
    "op8_disclosure": disclosure.query,
    "op9_bpe_chunks": chunk_bpe.query,
    "op10_quality_rules": quality_rules.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_conversation_repair": conversation_repair.query,
    "op13_sharding": sharding.query,
}
ORACLES: dict[str, str] = {
    "op1_url_filters": url_filters.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op13_sharding": sharding.ORACLE,
}
