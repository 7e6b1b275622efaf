"""The subpackage's queries and oracle SQL, gathered from its operators."""

from __future__ import annotations

from importlib import import_module

MODULES = ["media", "toxicity", "packing", "mixing", "quality", "ngram_join", "line_dedup", "fingerprint", "language_model", "repeats"]


def queries() -> dict:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"{__package__}.{name}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in MODULES:
        out |= import_module(f"{__package__}.{name}").ORACLE
    return out
