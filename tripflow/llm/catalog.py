"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tripflow.llm import (
    chat,
    codes,
    decontam,
    html,
    language,
    lines,
    near,
    packing,
    quality,
    runs,
    sharding,
    sigtree,
    toxicity,
)

QUERIES = {
    "op1_minhash": near.op1_minhash,
    "op2_decontam": decontam.op2_decontam,
    "op3_langid": language.op3_langid,
    "op4_quality": quality.op4_quality,
    "op4_ablations": quality.op4_ablations,
    "op5_packing": packing.op5_packing,
    "op6_htmltext": html.op6_htmltext,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_linededup": lines.op8_linededup,
    "op9_sharding": sharding.op9_sharding,
    "op10_chat": chat.op10_chat,
    "op11_runs": runs.op11_runs,
    "op12_jaccard": sigtree.op12_jaccard,
    "op13_codes": codes.op13_codes,
}

ORACLES = {
    "op1_minhash": near.ORACLE_SQL,
    "op4_quality": quality.ORACLE_SQL,
    "op4_ablations": quality.ABLATIONS_SQL,
    "op8_linededup": lines.ORACLE_SQL,
    "op11_runs": runs.ORACLE_SQL,
    "op12_jaccard": sigtree.ORACLE_SQL,
    "op13_codes": codes.ORACLE_SQL,
}
