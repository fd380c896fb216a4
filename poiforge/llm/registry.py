"""Queries of this subpackage, their SQL, and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_QUERIES = {
    "op1_substring_dedup": "substring_dedup",
    "op2_url_filters": "url_filters",
    "op3_decontaminate": "decontaminate",
    "op4_piece_sampling": "piece_sampling",
    "op5_suffix_dedup": "suffix_dedup",
    "op6_minhash_dedup": "minhash_dedup",
    "op7_ann": "ann",
    "op8_language_id": "language_id",
    "op9_pii": "pii",
    "op10_token_files": "token_files",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: getattr(import_module(f"poiforge.llm.{module}"), name) for name, module in _QUERIES.items()}
    return found | {"pipeline": import_module("corpus_pipeline").run}


def oracle_sql() -> dict[str, str]:
    found = {}
    for name, module in _QUERIES.items():
        if (sql := getattr(import_module(f"poiforge.llm.{module}"), "oracle", None)) is not None:
            found[name] = sql()
    return found
