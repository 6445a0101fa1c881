"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from importlib import import_module

#: Query name and module; each module has query(spark, sf_dir) and, where SQL can express it, ORACLE_SQL.
MODULES = {
    "op1_pii": "pii",
    "op2_langid": "langid",
    "op3_embedding_join": "embedding_join",
    "op4_html_text": "html_text",
    "op5_mixing": "mixing",
    "op6_substring_dedup": "substring_dedup",
    "op7_bpe": "bpe",
    "op8_quality_rules": "quality_rules",
    "op9_ngram_join": "ngram_join",
    "op10_quality_model": "quality_model",
    "op11_ranked_search": "ranked_search",
    "op12_fill_in_middle": "fill_in_middle",
    "op13_warc": "warc",
}


def queries() -> dict:
    return {name: import_module(f"{__package__}.{m}").query for name, m in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"{__package__}.{m}"), "ORACLE_SQL", None) for name, m in MODULES.items()}
    return {k: v for k, v in found.items() if v}
