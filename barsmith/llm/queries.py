"""Registered queries of this subpackage and the SQL that checks them."""
from __future__ import annotations

from barsmith.llm.bpe_codec import q_bpe_codec
from barsmith.llm.centroids import SQL_CENTROIDS, q_centroids
from barsmith.llm.chat_format import SQL_CHAT_FORMAT, q_chat_format
from barsmith.llm.decontaminate import q_decontaminate
from barsmith.llm.filter_audit import SQL_FILTER_AUDIT, q_filter_audit
from barsmith.llm.grace_dedup import SQL_EXACT_DEDUP, q_exact_dedup
from barsmith.llm.near_dedup import q_near_dedup
from barsmith.llm.pii import q_pii
from barsmith.llm.quality_rules import q_quality_rules
from barsmith.llm.repeats import SQL_REPEATS, q_repeats
from barsmith.llm.sharding import SQL_SHARDING, q_sharding
from barsmith.llm.token_counts import q_token_counts
from barsmith.llm.warc import SQL_WARC, q_warc

QUERIES = {
    "op1_pii": q_pii,
    "op2_quality_rules": q_quality_rules,
    "op3_chat_format": q_chat_format,
    "op4_repeats": q_repeats,
    "op5_warc": q_warc,
    "op6_bpe_codec": q_bpe_codec,
    "op7_near_dedup": q_near_dedup,
    "op8_decontaminate": q_decontaminate,
    "op9_sharding": q_sharding,
    "op10_token_counts": q_token_counts,
    "op11_centroids": q_centroids,
    "op12_exact_dedup": q_exact_dedup,
    "op13_filter_audit": q_filter_audit,
}

ORACLE = {
    "op3_chat_format": SQL_CHAT_FORMAT,
    "op4_repeats": SQL_REPEATS,
    "op5_warc": SQL_WARC,
    "op9_sharding": SQL_SHARDING,
    "op11_centroids": SQL_CENTROIDS,
    "op12_exact_dedup": SQL_EXACT_DEDUP,
    "op13_filter_audit": SQL_FILTER_AUDIT,
}
