"""Registry of named queries: id -> ``fn(spark, sf_dir) -> DataFrame`` and,
where the query is SQL-expressible, the equivalent DuckDB SQL oracle."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle_views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DESCRIPTIONS: dict[str, str] = {}


def register(qid: str, sql: str | None = None, views: tuple = (), doc: str = ""):
    """Decorator: register a query and (optionally) its oracle SQL."""
    def deco(fn):
        if qid in QUERIES:
            raise ValueError(f"duplicate query id {qid}")
        QUERIES[qid] = fn
        if sql is not None:
            ORACLE[qid] = with_views(sql, *views) if views else with_views(sql)
        DESCRIPTIONS[qid] = doc or (fn.__doc__ or "").strip().split("\n")[0]
        return fn
    return deco
