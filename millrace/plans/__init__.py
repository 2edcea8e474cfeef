"""Registered queries: operators bound to the provided tables, with their DuckDB equivalents."""

from __future__ import annotations

from . import analysis_queries, bundle_queries, catalog_queries, cycle_queries, entry_queries, ledger_queries, page_queries, registry, text_queries  # noqa: F401  importing registers the queries


def core_queries() -> tuple[dict, dict]:
    """(queries, DuckDB SQL) by name."""
    return registry.QUERIES, registry.ORACLES
