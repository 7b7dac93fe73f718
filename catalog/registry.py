"""Registered queries with their oracle SQL, and the SQL views both share."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, tuple[tuple[str, ...], str]] = {}
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def query(key: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register a query; its SQL may read the views named in ``uses``."""

    def register(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = (uses, sql)
        return fn

    return register


def view(name: str, sql: str, uses: tuple[str, ...] = ()) -> None:
    if name in VIEWS:
        raise ValueError(f"duplicate view {name}")
    VIEWS[name] = (uses, sql)


def with_views(uses: tuple[str, ...], sql: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dependency in VIEWS[name][0]:
            visit(dependency)
        ordered.append(name)

    for name in uses:
        visit(name)
    if not ordered:
        return sql
    body = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in ordered)
    if sql.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {body},\n{sql.removeprefix('WITH RECURSIVE ')}"
    return f"WITH {body}\n{sql}"


def oracle() -> dict[str, str]:
    return {key: with_views(uses, sql) for key, (uses, sql) in SQL.items()}
