"""Registered queries: a Spark callable and, where SQL can say it, the oracle text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywire.plans.tables import CTES

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``name``; ``sql`` may use the views ev, co, st and those in SHARED."""
    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = with_views(sql)
        return fn
    return add


# Further named subqueries for oracle texts; modules add theirs with ``share``.
SHARED: dict[str, str] = dict(CTES)


def share(name: str, sql: str) -> None:
    SHARED[name] = sql


def _mentions(sql: str, name: str) -> bool:
    return re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql, re.IGNORECASE) is not None


def with_views(sql: str) -> str:
    """Put the needed views in front of ``sql`` as a WITH clause."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in SHARED.items():
            if name not in needed and _mentions(text, name):
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    heads = ",\n".join(f"{n} AS ({SHARED[n]})" for n in needed)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    import importlib
    for module in MODULES:
        importlib.import_module(f"tallywire.plans.{module}")


MODULES = ["features_q", "cleaning_q", "explore_q", "metrics_q", "stream_q", "learn_q", "live_q", "curves_q"]
