"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, chat, decontaminate, licenses, mixing, quality, repair, secrets, sharding, simhash, spelling, substrings, tokens

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_chat": chat.op2_chat,
    "op3_tokens": tokens.op3_tokens,
    "op4_simhash": simhash.op4_simhash,
    "op5_licenses": licenses.op5_licenses,
    "op6_quality": quality.op6_quality,
    "quality_ablations": quality.quality_ablations,
    "op7_sharding": sharding.op7_sharding,
    "op8_mixing": mixing.op8_mixing,
    "op9_substrings": substrings.op9_substrings,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_repair": repair.op11_repair,
    "op12_spelling": spelling.op12_spelling,
    "op13_bpe": bpe.op13_bpe,
}

ORACLE_SQL = {
    "op6_quality": quality.OP6_SQL,
    "quality_ablations": quality.ABLATIONS_SQL,
}
