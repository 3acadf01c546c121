"""Query registry: name, inventory ids, Spark builder, and SQL over the same tables."""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskweave.sources.tables import Tables

MODULES = ("core", "silver", "quality", "matching", "scoring", "alerts", "evidence", "context")


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}
_CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    """A named SQL building block; it may refer to earlier ones."""
    _CTES[name] = sql.strip()


def block(name: str) -> str:
    """The SQL of a building block."""
    return _CTES[name]


def query(name: str, ids: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = Query(name, ids, fn, sql)
        return fn

    return register


def with_blocks(sql: str) -> str:
    """Prefix ``sql`` with the blocks it uses, in dependency order.

    ``rnd(x, n)`` stands for rounding with the same tiny nudge as ``shape.tidy``.
    """
    order: list[str] = []

    def visit(text: str) -> None:
        for n in _CTES:
            if n not in order and re.search(rf"\b{n}\b", text):
                visit(_CTES[n])
                if n not in order:
                    order.append(n)

    visit(sql)
    body = sql.strip()
    if order:
        blocks = ",\n".join(f"{n} AS MATERIALIZED (\n{_CTES[n]}\n)" for n in order)
        body = f"WITH {blocks},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {blocks}\n{body}"
    return re.sub(r"\brnd\(", "round(1e-9 + ", body)


def load_all() -> dict[str, Query]:
    for m in MODULES:
        importlib.import_module(f"riskweave.catalog.{m}")
    return _QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return q.build(Tables(spark, folder))

        run.__name__ = q.name
        return run

    return {n: bind(q) for n, q in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {n: with_blocks(q.sql) for n, q in load_all().items() if q.sql}
