"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from clickloom.llm import (
    chat_prefix,
    conversation_repair,
    fair_mixing,
    ffd_packing,
    hard_negatives,
    language_gru,
    learned_partitions,
    merkle,
    minhash_forest,
    pivot_links,
    token_store,
    toxicity_chain,
    vector_sharding,
)

OPERATORS = {
    "op1_chat_prefix": chat_prefix,
    "op2_token_store": token_store,
    "op3_minhash_forest": minhash_forest,
    "op4_merkle": merkle,
    "op5_language_gru": language_gru,
    "op6_vector_sharding": vector_sharding,
    "op7_learned_partitions": learned_partitions,
    "op8_toxicity_chain": toxicity_chain,
    "op9_ffd_packing": ffd_packing,
    "op10_fair_mixing": fair_mixing,
    "op11_conversation_repair": conversation_repair,
    "op12_pivot_links": pivot_links,
    "op13_hard_negatives": hard_negatives,
}


def queries() -> dict:
    return {name: module.query for name, module in OPERATORS.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {name: module.SQL for name, module in OPERATORS.items() if hasattr(module, "SQL")}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
