"""Query registration."""

from __future__ import annotations

import re
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from stationtide.suite.views import VIEW_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query; ``sql`` may use the view names of :mod:`stationtide.suite.views`."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = with_views(sql)
        return fn

    return add


def with_views(sql: str) -> str:
    """Prefix the definitions of the views the statement uses, in dependency order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEW_SQL:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEW_SQL[name])

    visit(sql)
    if not needed:
        return sql
    ctes = ", ".join(f"{n} AS ({VIEW_SQL[n]})" for n in VIEW_SQL if n in needed)
    return f"WITH {ctes} {sql}"
