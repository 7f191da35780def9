"""Queries by name, each with an independent SQL form where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .views import VIEW_SQL, Views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def oracle(sql: str, *views: str) -> str:
    """DuckDB SQL that first defines the named views, in dependency order."""
    needed: list[str] = []

    def add(name: str) -> None:
        text = VIEW_SQL[name]
        for other in VIEW_SQL:
            if other != name and f" {other} " in f" {text} ".replace("\n", " ").replace(")", " ").replace("(", " ").replace(",", " "):
                add(other)
        if name not in needed:
            needed.append(name)

    for v in views:
        add(v)
    head = ", ".join(f"{v} as ({VIEW_SQL[v]})" for v in needed)
    body = sql.strip()
    if not head:
        return body
    if body.lower().startswith("with recursive "):
        return f"with recursive {head}, {body[15:]}"
    if body.lower().startswith("with "):
        return f"with {head}, {body[5:]}"
    return f"with {head} {body}"


def query(name: str, sql: str | None = None, *views: str) -> Callable:
    """Registers ``f(v: Views) -> DataFrame`` under a name, with its oracle."""

    def wrap(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql, *views)
        return f

    return wrap
