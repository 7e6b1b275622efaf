"""All queries of the engine with their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is the DuckDB SQL that must return the same rows."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f

    return add


def queries() -> dict[str, Callable]:
    import_module(f"{__package__}.queries")
    return QUERIES


def oracle_sql() -> dict[str, str]:
    import_module(f"{__package__}.queries")
    return ORACLE
