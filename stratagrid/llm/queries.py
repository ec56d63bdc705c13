"""The corpus operators' queries, and SQL for those that SQL can express."""

from __future__ import annotations

from . import chat, decontamination, licenses, lines, ngram, packing, simhash, topk, toxicity, warc

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_chat_format": chat.op2_chat_format,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_lm_scoring": ngram.op4_lm_scoring,
    "op5_warc": warc.op5_warc,
    "op6_line_dedup": lines.op6_line_dedup,
    "op7_simhash": simhash.op7_simhash,
    "op8_top_k": topk.op8_top_k,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_decontamination": decontamination.op10_decontamination,
}

ORACLE_SQL = {
    "op2_chat_format": chat.OP2_SQL,
    "op5_warc": warc.OP5_SQL,
    "op6_line_dedup": lines.OP6_SQL,
    "op8_top_k": topk.OP8_SQL,
    "op9_license_scan": licenses.OP9_SQL,
    "op10_decontamination": decontamination.OP10_SQL,
}
