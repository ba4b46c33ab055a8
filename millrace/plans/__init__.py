"""Registered queries and end-to-end jobs."""

from __future__ import annotations

import importlib

_MODULES = (
    "clickstream",
    "table_jobs",
    "preparation",
    "relational",
    "modeling",
    "monitoring",
    "text_jobs",
    "streams",
    "learning",
    "workflows",
)


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"millrace.plans.{name}")


def all_queries() -> dict:
    _load()
    from millrace.plans.registry import QUERIES

    return dict(QUERIES)


def all_sql() -> dict:
    _load()
    from millrace.plans.registry import SQL

    return dict(SQL)
