"""Registered queries: each operator on the given tables, with the SQL it must agree with."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` and, where one exists, its SQL."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def load_all() -> None:
    from registry import (  # noqa: F401
        exports,
        files,
        histories,
        late,
        logs,
        merges,
        projections,
        retentions,
        streams,
    )
