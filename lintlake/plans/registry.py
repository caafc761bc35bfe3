"""Registered queries and their SQL oracles."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lintlake.plans.fixtures import GIVEN, VIEWS, Fixtures

Query = Callable[[Fixtures], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}

for _name, _sql in VIEWS.items():
    CTES[_name] = _sql.format(**{n: n for n in [*VIEWS, *GIVEN]})


def ctes(**texts: str) -> None:
    """Name intermediate results of the oracles."""
    CTES.update(texts)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def _mentioned(sql: str) -> set[str]:
    return set(re.findall(r"(?:\b(?:from|join)\s+\(?\s*|,\s*)([a-z_]+)\b", sql)) & set(CTES)


def _needed(sql: str, visited: set[str], order: list[str]) -> None:
    """Append the named results a text refers to, dependencies first."""
    for name in sorted(_mentioned(sql) - visited):
        if name not in visited:
            visited.add(name)
            _needed(CTES[name], visited, order)
            order.append(name)


def full_sql(sql: str) -> str:
    """An oracle with the named results it uses in front."""
    order: list[str] = []
    _needed(sql, set(), order)
    recursive = "recursive " if "recursive_" in sql else ""
    heads = [f"{name} as ({CTES[name].strip()})" for name in order]
    body = sql.strip()
    if not heads:
        return body
    joint = ",\n" if body.lower().startswith("with ") else "\n"
    return f"with {recursive}" + ",\n".join(heads) + joint + (body[5:] if joint[0] == "," else body)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: function(Fixtures(spark, sf_dir))

    return {name: bind(function) for name, function in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: full_sql(sql) for name, sql in ORACLES.items()}
