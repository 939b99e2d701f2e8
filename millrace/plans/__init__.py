"""The queries of the core, one module per family; each module has its own registry R."""

from __future__ import annotations

from importlib import import_module

from millrace.plans.registry import Query

MODULES = ("packed", "snapshots", "relational", "ranking", "quality", "graphs", "logs", "extra", "audits", "more")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for name in MODULES:
        registry = import_module(f"millrace.plans.{name}").R
        queries |= registry.queries
        sql |= registry.sql
    return queries, sql
