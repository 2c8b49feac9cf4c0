"""The queries of this subpackage's operators, by name, and the SQL that says the same where SQL can."""

from __future__ import annotations

import importlib

from lumenforge.llm import sql

_WHERE = {
    "op1_log_bloom_scoring": "log_bloom",
    "op2_multiprobe_ann": "multiprobe",
    "op3_token_blocks": "pfor",
    "op4_chained_passages": "chaining",
    "op5_parity_join": "parity",
    "op6_suffix_dedup": "suffixes",
    "op7_label_shards": "label_shards",
    "op8_language_masks": "language",
    "op9_string_tiling": "tiling",
    "op10_best_fit_packing": "packing",
    "op11_conversation_repair": "conversations",
    "op12_hard_negatives": "hard_negatives",
    "op13_page_text": "pages",
}


def _later(name: str, module: str):
    return lambda spark, sf_dir: getattr(importlib.import_module(f"lumenforge.llm.{module}"), name)(spark, sf_dir)


def queries() -> dict:
    return {name: _later(name, module) for name, module in _WHERE.items()}


def oracle_sql() -> dict[str, str]:
    return {"op5_parity_join": sql.PARITY_JOIN, "op6_suffix_dedup": sql.SUFFIX_DEDUP, "op12_hard_negatives": sql.HARD_NEGATIVES}
