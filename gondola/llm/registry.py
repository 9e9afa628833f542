"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import chat, class_lm, decontaminate, exact_dedup, filter_audit, html_text, langid, licenses, mixing, sharding, simhash, token_align, url_filter

QUERIES = {
    "op1_language_id": langid.query,
    "op2_sharding": sharding.query,
    "op3_decontaminate": decontaminate.query,
    "op4_simhash": simhash.query,
    "op5_class_lm": class_lm.query,
    "op6_exact_dedup": exact_dedup.query,
    "op7_chat": chat.query,
    "op8_main_text": html_text.query,
    "op9_licenses": licenses.query,
    "op10_mixing": mixing.query,
    "op11_token_align": token_align.query,
    "op12_filter_audit": filter_audit.query,
    "op13_url_filter": url_filter.query,
}

SQL: dict[str, str] = {
    "op3_decontaminate": decontaminate.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op7_chat": chat.SQL,
    "op9_licenses": licenses.SQL,
    "op10_mixing": mixing.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_url_filter": url_filter.SQL,
}
