"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, chat, decontaminate, fingerprints, langid, lines, lm, simhash, substrings, urls


def queries() -> dict:
    return {
        "op1_byte_bpe": bpe.op1_byte_bpe,
        "op2_fingerprints": fingerprints.op2_fingerprints,
        "op3_decontamination": decontaminate.op3_decontamination,
        "op4_chat_format": chat.op4_chat_format,
        "op5_lm_score": lm.op5_lm_score,
        "op6_language_id": langid.op6_language_id,
        "op7_simhash": simhash.op7_simhash,
        "op8_url_filter": urls.op8_url_filter,
        "op9_line_dedup": lines.op9_line_dedup,
        "op10_substring_dedup": substrings.op10_substring_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": decontaminate.ORACLE, "op4_chat_format": chat.ORACLE, "op8_url_filter": urls.ORACLE, "op9_line_dedup": lines.ORACLE, "op10_substring_dedup": substrings.ORACLE}
