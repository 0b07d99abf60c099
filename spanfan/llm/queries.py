"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from spanfan.llm import (
    chat_format,
    decontaminate,
    line_dedup,
    minhash_near,
    neighbours,
    packing,
    periodic_runs,
    pii_surrogates,
    quality_rules,
    secret_scan,
    sharding,
    suffix_dedup,
    whitening,
)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_packing": packing.op3_packing,
    "op4_pii_surrogates": pii_surrogates.op4_pii_surrogates,
    "op5_minhash_near": minhash_near.op5_minhash_near,
    "op6_sharding": sharding.op6_sharding,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op8_chat_format": chat_format.op8_chat_format,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_neighbours": neighbours.op11_neighbours,
    "op12_whitening": whitening.op12_whitening,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

SQL = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op5_minhash_near": minhash_near.OP5_SQL,
    "op8_chat_format": chat_format.OP8_SQL,
    "op10_suffix_dedup": suffix_dedup.OP10_SQL,
}
