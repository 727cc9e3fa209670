"""Queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

import importlib

MODULES = [
    "quarry.llm.line_dedup",
    "quarry.llm.exact_dedup",
    "quarry.llm.url_filters",
    "quarry.llm.warc",
    "quarry.llm.mixing",
    "quarry.llm.language_id",
    "quarry.llm.packing",
    "quarry.llm.token_binary",
    "quarry.llm.ngram_join",
    "quarry.llm.neighbours",
    "quarry.llm.conversations",
    "quarry.llm.hard_negatives",
    "quarry.llm.simhash",
]


def _merged(name: str) -> dict:
    out: dict = {}
    for module in MODULES:
        out.update(getattr(importlib.import_module(module), name, {}))
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLE")
