"""All queries and their reference SQL by name."""

from __future__ import annotations

from refpanel.workload import curation, pipelines, scoring, sequences, texts

_MODULES = (scoring, curation, sequences, texts, pipelines)


def queries() -> dict:
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
