"""Registry of the queries and of the SQL they are checked against."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import views


@dataclass(frozen=True)
class Entry:
    name: str
    run: Callable[[views.Tables], DataFrame]
    body: str | None
    ctes: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] | str = ()):
    """Register ``fn(tables) -> DataFrame`` with its SQL (views it mentions are added as CTEs)."""

    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Entry(name, fn, sql, (ctes,) if isinstance(ctes, str) else tuple(ctes))
        return fn

    return add


def runnable(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: entry.run(views.Tables(spark, sf_dir))


def full_sql(entry: Entry) -> str:
    text = " ".join([*entry.ctes, entry.body])
    needed: list[str] = []

    def uses(sql, name):
        return re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql)

    def visit(name):
        for other in views.SQL:
            if other != name and other not in needed and uses(views.SQL[name], other):
                visit(other)
        if name not in needed:
            needed.append(name)

    for name in views.SQL:
        if uses(text, name):
            visit(name)
    # Views that queries read more than once are computed once.
    kept = {"lake": "MATERIALIZED ", "packed": "MATERIALIZED "}
    ctes = [f"{n} AS {kept.get(n, '')}({views.SQL[n]})" for n in needed] + list(entry.ctes)
    return (f"WITH RECURSIVE {', '.join(ctes)} " if ctes else "") + entry.body
