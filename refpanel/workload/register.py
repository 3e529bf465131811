"""How the query modules register their queries."""

from __future__ import annotations


def registrar(queries: dict, sql_texts: dict[str, str]):
    """A decorator factory ``query(name, sql)`` that fills the two tables of a module."""

    def query(name: str, sql: str | None = None):
        def add(fn):
            queries[name] = fn
            if sql is not None:
                sql_texts[name] = sql
            return fn

        return add

    return query
