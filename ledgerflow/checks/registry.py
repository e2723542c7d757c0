"""Registration of a query with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.checks.views import SQL_VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _with_views(sql: str, views: tuple[str, ...]) -> str:
    """Put the named views, and the views those use, before the statement."""
    wanted: list[str] = []

    def need(name: str) -> None:
        text, uses = SQL_VIEWS[name]
        for other in uses:
            need(other)
        if name not in wanted:
            wanted.append(name)

    for view in views:
        need(view)
    if not wanted:
        return sql.strip()
    heads = ",\n".join(f"{name} AS ({SQL_VIEWS[name][0].strip()})" for name in wanted)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"


def check(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = _with_views(sql, views)
        return query

    return register
