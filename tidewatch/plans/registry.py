"""Registry of named query plans and their ANSI-SQL (DuckDB) twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# decimals kept in compared outputs (both sides round the same way)
DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r(c: str | Column, alias: str | None = None, digits: int = DIGITS) -> Column:
    """Round a DOUBLE output column for comparison."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col.cast("double"), digits)
    name = alias or (c if isinstance(c, str) else None)
    return out.alias(name) if name else out
