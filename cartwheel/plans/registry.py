"""Registered queries and the SQL each of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.plans.star import STAR_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query. ``sql`` follows the star views; further CTEs start with a comma."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = f"WITH {STAR_SQL.strip()}{sql if sql.lstrip().startswith(',') else chr(10) + sql}"
        return fn

    return register
