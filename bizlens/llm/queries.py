"""Registered queries of the subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from bizlens.llm.chat_formatting import ORACLE_OP2, op2_chat_formatting
from bizlens.llm.conversation_repair import op12_conversation_repair
from bizlens.llm.cover_tree import ORACLE_OP11, op11_embedding_near_dedup
from bizlens.llm.decontamination import ORACLE_OP7, op7_benchmark_decontamination
from bizlens.llm.packing import op5_packing
from bizlens.llm.quality_classifier import op8_quality_classifier
from bizlens.llm.quality_rules import op3_quality_rules
from bizlens.llm.secret_scans import op4_secret_scans
from bizlens.llm.simhash import op9_simhash_near_dedup
from bizlens.llm.source_divergence import ORACLE_OP13, op13_source_divergence
from bizlens.llm.token_counts import op1_token_counts
from bizlens.llm.url_filters import ORACLE_OP10, op10_url_filters
from bizlens.llm.warc import ORACLE_OP6, op6_warc

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_quality_rules": op3_quality_rules,
    "op4_secret_scans": op4_secret_scans,
    "op5_packing": op5_packing,
    "op6_warc": op6_warc,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_url_filters": op10_url_filters,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op2_chat_formatting": ORACLE_OP2,
    "op6_warc": ORACLE_OP6,
    "op7_benchmark_decontamination": ORACLE_OP7,
    "op10_url_filters": ORACLE_OP10,
    "op11_embedding_near_dedup": ORACLE_OP11,
    "op13_source_divergence": ORACLE_OP13,
}
