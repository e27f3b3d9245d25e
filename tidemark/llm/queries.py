"""Registered queries of the subpackage and the SQL of those SQL can express."""

from __future__ import annotations

from tidemark.llm import (chat, classlm, decontaminate, hard_negatives, langid, packing, quality, rans, resample,
                          secrets, simhash, urls, warc)

QUERIES = {
    "op1_warc_roundtrip": warc.q_warc,
    "op2_simhash_groups": simhash.q_simhash,
    "op3_template_leaks": decontaminate.q_decontaminate,
    "op4_chat_format": chat.q_chat,
    "op5_rans_token_files": rans.q_token_files,
    "op6_nnls_packing": packing.q_packing,
    "op7_secret_spans": secrets.q_secrets,
    "op8_quality_ledger": quality.q_quality,
    "op9_url_verdicts": urls.q_urls,
    "op10_language": langid.q_langid,
    "op11_hard_negatives": hard_negatives.q_hard_negatives,
    "op12_resample": resample.q_resample,
    "op13_class_lm": classlm.q_class_lm,
}

ORACLE = {
    "op1_warc_roundtrip": warc.SQL,
    "op4_chat_format": chat.SQL,
    "op8_quality_ledger": quality.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
}
