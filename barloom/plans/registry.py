"""All registered queries and their SQL oracles (merged from the query modules)."""

from __future__ import annotations

import importlib

_MODULES = [
    ("barloom.plans.queries", "QUERIES", "barloom.plans.oracle", "ORACLE"),
    ("barloom.plans.indicator_queries", "SPARK", "barloom.plans.indicator_queries", "SQL"),
    ("barloom.plans.table_queries", "SPARK", "barloom.plans.table_queries", "SQL"),
    ("barloom.plans.learning_queries", "SPARK", "barloom.plans.learning_queries", "SQL"),
    ("barloom.plans.stream_queries", "SPARK", "barloom.plans.stream_queries", "SQL"),
]


def all_queries() -> dict:
    out = {}
    for qm, qn, _, _ in _MODULES:
        out.update(getattr(importlib.import_module(qm), qn))
    return out


def all_oracles() -> dict:
    out = {}
    for _, _, om, on in _MODULES:
        out.update(getattr(importlib.import_module(om), on))
    return out
