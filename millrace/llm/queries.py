"""The queries of this subpackage, by problem."""

from __future__ import annotations

from importlib import import_module

from millrace.llm.registry import R
from millrace.plans.registry import Query

MODULES = ("pairs", "encoding", "overlap", "splits", "canon", "tokens", "mixture", "pii")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for name in MODULES:
        import_module(f"millrace.llm.{name}")
    return R.queries, R.sql
