"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tailtrim.llm import (
    chat,
    decontamination,
    fingerprints,
    language,
    linededup,
    merkle,
    mixing,
    neardup,
    periods,
    secrets,
    sharding,
    tokens,
    toxicity,
)

QUERIES = {
    "op1_language": language.op1_language,
    "op2_linededup": linededup.op2_linededup,
    "op3_neardup": neardup.op3_neardup,
    "op4_tokens": tokens.op4_tokens,
    "op5_mixing": mixing.op5_mixing,
    "op6_sharding": sharding.op6_sharding,
    "op7_chat": chat.op7_chat,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_fingerprints": fingerprints.op10_fingerprints,
    "op11_merkle": merkle.op11_merkle,
    "op12_secrets": secrets.op12_secrets,
    "op13_periods": periods.op13_periods,
}

ORACLE_SQL = {
    "op2_linededup": linededup.OP2_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op6_sharding": sharding.OP6_SQL,
    "op11_merkle": merkle.OP11_SQL,
}
