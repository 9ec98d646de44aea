"""The training-data queries and the SQL for those that SQL can express."""

from __future__ import annotations

from . import audit, chat, collocations, decontaminate, html_text, language, licences, mixing, packing, quality, simhash, sketch, toxicity


def queries() -> dict:
    return {
        "op1_packing": packing.op1_packing,
        "op2_mixing": mixing.op2_mixing,
        "op4_quality_rules": quality.op4_quality_rules,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_language": language.op6_language,
        "op3_licences": licences.op3_licences,
        "op7_html_text": html_text.op7_html_text,
        "op8_fingerprints": sketch.op8_fingerprints,
        "op9_chat": chat.op9_chat,
        "op10_simhash": simhash.op10_simhash,
        "op11_filter_audit": audit.op11_filter_audit,
        "op12_decontaminate": decontaminate.op12_decontaminate,
        "op13_collocations": collocations.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": mixing.ORACLE_SQL,
        "op4_quality_rules": quality.ORACLE_SQL,
        "op9_chat": chat.ORACLE_SQL,
        "op11_filter_audit": audit.ORACLE_SQL,
        "op12_decontaminate": decontaminate.ORACLE_SQL,
        "op13_collocations": collocations.ORACLE_SQL,
    }
