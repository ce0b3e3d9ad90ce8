"""The numbered queries of this subpackage, for the entry module to register."""

from __future__ import annotations

from barlab.llm import (q_decontaminate, q_exact, q_language, q_lexical, q_licenses, q_merkle, q_mixing, q_near, q_packing,
                        q_quality, q_tokens, q_toxicity, q_warc)

QUERIES = {
    "op1_exact_dedup": q_exact.op1_exact_dedup,
    "op2_near_dedup": q_near.op2_near_dedup,
    "op3_decontamination": q_decontaminate.op3_decontamination,
    "op4_license_scan": q_licenses.op4_license_scan,
    "op5_toxicity": q_toxicity.op5_toxicity,
    "op6_quality": q_quality.op6_quality,
    "op7_language_id": q_language.op7_language_id,
    "op8_token_counts": q_tokens.op8_token_counts,
    "op9_mixing": q_mixing.op9_mixing,
    "op10_token_packing": q_packing.op10_token_packing,
    "op11_warc": q_warc.op11_warc,
    "op12_merkle_manifest": q_merkle.op12_merkle_manifest,
    "op13_lexical_search": q_lexical.op13_lexical_search,
}

ORACLE_SQL = {
    "op1_exact_dedup": q_exact.SQL,
    "op3_decontamination": q_decontaminate.SQL,
    "op4_license_scan": q_licenses.SQL,
    "op9_mixing": q_mixing.SQL,
    "op11_warc": q_warc.SQL,
    "op12_merkle_manifest": q_merkle.SQL,
    "op13_lexical_search": q_lexical.SQL,
}
