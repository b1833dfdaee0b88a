"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

import importlib

from tidepool.session import prepare

MODULES = {
    "op8_suffix_dedup": "suffix_dedup",
    "op6_lm_score": "lm_score",
    "op2_near_duplicates": "near_dup",
    "op7_pii": "pii",
    "op5_licenses": "licenses",
    "op3_quality": "quality",
    "op1_exact_dedup": "exact_dedup",
    "op4_pack": "packing",
    "op9_chat_format": "chat_format",
    "op10_decontaminate": "decontaminate",
    "op11_whiten": "whitening",
    "op12_line_dedup": "line_dedup",
    "op13_token_align": "token_align",
}


def _query(name: str):
    fn = getattr(importlib.import_module(f"tidepool.llm.{MODULES[name]}"), name)

    def run(spark, sf_dir):
        return fn(prepare(spark), sf_dir)

    run.__name__, run.__doc__ = name, fn.__doc__
    return run


def queries() -> dict:
    return {name: _query(name) for name in MODULES}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(importlib.import_module(f"tidepool.llm.{m}"), "SQL", None) for name, m in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
