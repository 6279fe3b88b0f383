"""Queries over the test tables, by name, with the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from leafmill.plans import fields, knowledge, storage

MODULES = (knowledge, fields, storage)


def all_queries() -> dict[str, Callable]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: q for m in MODULES for name, q in m.SQL.items()}
