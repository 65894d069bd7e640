"""The queries of the corpus operators and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "html_crf",
    "quality",
    "bpe",
    "exact_dedup",
    "suffix_dedup",
    "ngram_join",
    "decontaminate",
    "url_filter",
    "warc",
    "secrets",
    "toxicity",
    "filter_audit",
    "periodic",
]


def _merged(name: str) -> dict:
    return {key: value for module in MODULES for key, value in getattr(import_module(f"tabloom.llm.{module}"), name).items()}


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("SQL")
