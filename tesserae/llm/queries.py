"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import chat, decontaminate, divergence, fingerprints, importance, language, mixing, pii, ppm, quality, simhash, tokens, urls

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_ppm": ppm.op2_ppm,
    "op3_urls": urls.op3_urls,
    "op4_simhash": simhash.op4_simhash,
    "op5_mix": mixing.op5_mix,
    "op6_quality": quality.op6_quality,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_chat": chat.op9_chat,
    "op10_token_counts": tokens.op10_token_counts,
    "op11_language": language.op11_language,
    "op12_importance": importance.op12_importance,
    "op13_divergence": divergence.op13_divergence,
}

ORACLES: dict[str, str] = {"op3_urls": urls.ORACLE, "op5_mix": mixing.ORACLE, "op9_chat": chat.ORACLE, "op13_divergence": divergence.ORACLE}
