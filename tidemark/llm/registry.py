"""The registered queries of the training-data operators, and SQL where SQL can express one."""

from __future__ import annotations

from tidemark.llm import (
    chat, decontamination, groups, lines, manifest, mixing, pseudonyms, quality, repair, sharding, simhash, toxicity, urls,
)

QUERIES = {
    "op1_feistel_pseudonyms": pseudonyms.query,
    "op2_spaced_seed_decontamination": decontamination.query,
    "op3_ftrl_toxicity": toxicity.query,
    "op4_line_dedup": lines.query,
    "op5_chat_formatting": chat.query,
    "op6_url_templates": urls.query,
    "op7_block_mixing": mixing.query,
    "op8_covering_simhash": simhash.query,
    "op9_label_propagation_sharding": sharding.query,
    "op10_weak_supervision_quality": quality.query,
    "op11_merkle_manifest": manifest.query,
    "op12_token_group_join": groups.query,
    "op13_conversation_repair": repair.query,
}

SQL = {
    "op5_chat_formatting": chat.SQL,
    "op11_merkle_manifest": manifest.SQL,
    "op12_token_group_join": groups.SQL,
    "op13_conversation_repair": repair.SQL,
}
