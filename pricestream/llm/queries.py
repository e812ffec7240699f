"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import importlib

_MODULES = ("op1_token_codes", "op2_lm_scoring", "op3_toxicity", "op4_best_fit_packing", "op5_substring_dedup", "op6_html_extraction", "op7_fingerprints", "op8_simhash_dedup", "op9_quality_rules", "op10_bpe",
            "op11_hilbert_sharding", "op12_structure_repair", "op13_tokenizer_alignment")


def _load():
    for name in _MODULES:
        yield name, importlib.import_module(f"{__package__}.{name}")


def registry() -> dict:
    return {name: getattr(module, name) for name, module in _load()}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE for name, module in _load() if getattr(module, "ORACLE", None)}
