"""The register of queries: a function, the SQL that it is held against, and the operators it covers."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def query(*covers: str, sql: str | None = None):
    def put(function):
        name = function.__name__
        QUERIES[name] = function
        COVERS[name] = covers
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return put
