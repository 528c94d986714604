"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from annalist.llm import bpe, chat_format, decontaminate, language_id, line_dedup, pii, quality, secrets, simhash, url_filter

QUERIES = {
    "op1_chat_format": chat_format.query,
    "op2_secrets": secrets.query,
    "op3_line_dedup": line_dedup.query,
    "op4_pii": pii.query,
    "op5_simhash": simhash.query,
    "op6_decontaminate": decontaminate.query,
    "op7_quality": quality.query,
    "op8_bpe": bpe.query,
    "op9_language_id": language_id.query,
    "op10_url_filter": url_filter.query,
}

ORACLES = {
    "op1_chat_format": chat_format.ORACLE,
    "op3_line_dedup": line_dedup.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
}
