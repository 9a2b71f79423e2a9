"""Queries and DuckDB texts of the training-data operators."""

from __future__ import annotations

from quarrystone.llm import bpe, decontaminate, language_id, line_dedup, merkle, packing, quality_fm, quality_rules, runs, simhash, token_counts, toxicity, warc

MODULES = {
    "op1_token_counts": token_counts,
    "op2_simhash": simhash,
    "op3_toxicity": toxicity,
    "op4_packing": packing,
    "op5_quality_fm": quality_fm,
    "op6_warc": warc,
    "op7_language_id": language_id,
    "op8_line_dedup": line_dedup,
    "op9_quality_rules": quality_rules,
    "op10_decontaminate": decontaminate,
    "op11_periodic_runs": runs,
    "op12_byte_bpe": bpe,
    "op13_merkle": merkle,
}


def queries() -> dict:
    return {name: module.query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in MODULES.items() if getattr(module, "SQL", None)}
