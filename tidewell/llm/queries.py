"""The registered queries of this package and their SQL, by name."""

import importlib

# Query name -> module. A module has a function of the query's name, and ORACLE where SQL can say it.
MODULES = {
    "op1_license_scan": "license_scan",
    "op10_simhash_near_dedup": "simhash_dedup",
    "op5_quality_classifier": "quality_classifier",
    "op6_line_dedup": "line_dedup",
    "op2_token_counts": "token_counts",
    "op3_language_id": "language_id",
    "op4_quality_rules": "quality_rules",
    "op7_benchmark_decontamination": "decontamination",
    "op8_bpe_round_trip": "bpe",
    "op9_chat_formatting": "chat_format",
    "op11_best_fit_packing": "packing",
    "op12_phrase_collocations": "collocations",
    "op13_merkle_manifest": "merkle",
}


def _modules():
    for name, module in MODULES.items():
        yield name, importlib.import_module(f"tidewell.llm.{module}")


def queries() -> dict:
    return {name: getattr(module, name) for name, module in _modules()}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE for name, module in _modules() if getattr(module, "ORACLE", None)}
