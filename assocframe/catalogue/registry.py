"""Registration of named queries and the SQL fragments their checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assocframe.fixtures import variants_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its check, if SQL can express it."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def with_v(sql: str, *ctes: str, row_key: bool = False) -> str:
    """Check SQL that sees the variants table as ``V``."""
    return "WITH " + ", ".join([f"V AS ({variants_sql(row_key=row_key)})", *ctes]) + " " + sql


def rnd(expr: str, digits: int) -> str:
    if digits == 0:
        return f"round_even({expr}, 0)"
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits})"


def pct(part: str, whole: str, digits: int) -> str:
    return rnd(f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * 1e2", digits)


CHR_RANK = "CASE WHEN regexp_full_match(chr, '[0-9]+') THEN CAST(chr AS BIGINT) WHEN chr IS NOT NULL THEN 999 END"
