"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Each query module decorates its builders with ``@query(name, sql)``; the SQL is
the same question asked of the same parquet tables in plain ANSI SQL (views
region, nation, customer, ... are pre-registered by the checker).  Queries whose
semantics SQL cannot state register ``sql=None``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every query module so its decorators run."""
    from techmine.plans import (  # noqa: F401
        q_curation, q_graph, q_kept, q_model, q_reports, q_sources, q_text, q_vectors)
