"""The registered query of each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from riskmart.llm import (cpsj, debruijn, langid, negatives, packing, quality, quoting, records, repair, spaced, suffixes,
                          templates, toxicity)

QUERIES = {
    "op1_quality_rules": quality.query,
    "op2_language_id": langid.query,
    "op3_quotation_linking": quoting.query,
    "chat_mail_linking": quoting.mail_query,
    "op4_toxicity": toxicity.query,
    "op5_substring_dedup": debruijn.query,
    "op6_binary_records": records.query,
    "op7_best_fit_packing": packing.query,
    "op8_minhash_dedup": cpsj.query,
    "op9_license_templates": templates.query,
    "op10_spaced_seeds": spaced.query,
    "op11_suffix_dedup": suffixes.query,
    "op12_hard_negatives": negatives.query,
    "op13_conversation_repair": repair.query,
}

SQL = {
    "op1_quality_rules": quality.SQL,
    "op3_quotation_linking": quoting.sql(),
    "chat_mail_linking": quoting.sql(mail=True),
    "op5_substring_dedup": debruijn.SQL,
    "op8_minhash_dedup": cpsj.SQL,
    "op9_license_templates": templates.sql(),
    "op11_suffix_dedup": suffixes.SQL,
    "op12_hard_negatives": negatives.SQL,
    "op13_conversation_repair": repair.SQL,
}
